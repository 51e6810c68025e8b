"""Named chunk collections: merge rules and where the rows live."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, IntegerType, MapType, StringType, StructField, StructType

from trawlnet.session import cut_lineage

COLLECTION_SCHEMA = StructType(
    [
        StructField("collection_id", StringType()),
        StructField("id", StringType()),
        StructField("document", StringType()),
        StructField("path", StringType()),
        StructField("start_line", IntegerType()),
        StructField("end_line", IntegerType()),
        StructField("metadata", MapType(StringType(), StringType())),
        StructField("embedder", StringType()),
        StructField("embedding", ArrayType(FloatType())),
    ]
)
KEY = ["collection_id", "id"]


def conform(rows: DataFrame) -> DataFrame:
    """The collection columns in order; absent ones become NULL."""
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in COLLECTION_SCHEMA
        ]
    )


def one_per_key(rows: DataFrame, key: list[str], newest_by: str | None = None) -> DataFrame:
    """One row per key: the highest ``newest_by``, else the lowest row. Combines before the shuffle,
    so many copies of one key do not meet in one task."""
    payload = [c for c in rows.columns if c not in key and c != newest_by and not _is_map(rows, c)]
    maps = [c for c in rows.columns if _is_map(rows, c)]
    row = F.struct(*[F.col(c) for c in payload + maps])
    if newest_by:
        chosen = F.max_by(row, F.col(newest_by))
    else:
        chosen = F.min_by(row, F.struct(*[F.col(c) for c in payload]))
    return rows.groupBy(*key).agg(chosen.alias("_row")).select(*[k for k in key], "_row.*")


def _is_map(rows: DataFrame, column: str) -> bool:
    return rows.schema[column].dataType.typeName() == "map"


def missing_rows(existing: DataFrame, incoming: DataFrame, key: list[str] = KEY, unique: bool = False) -> DataFrame:
    """The incoming rows whose key is not stored yet, once each.

    Copies of a key are combined before the join, so a hot key reaches it as one row, already
    placed by key. ``unique`` says that no key comes twice, which saves the combining.
    """
    once = incoming if unique else one_per_key(incoming, key).select(*incoming.columns)
    return once.join(existing.select(*key), key, "left_anti")


def insert_missing(existing: DataFrame, incoming: DataFrame, key: list[str] = KEY, unique: bool = False) -> DataFrame:
    """Stored rows win; only new keys are added."""
    return existing.unionByName(missing_rows(existing, incoming, key, unique))


def upsert(existing: DataFrame, incoming: DataFrame, key: list[str] = KEY, unique: bool = False) -> DataFrame:
    """Incoming rows win over stored rows with the same key."""
    kept = existing.join(incoming.select(*key), key, "left_anti")
    return kept.unionByName(incoming if unique else one_per_key(incoming, key).select(*incoming.columns))


def _newest(rows: DataFrame, newest_by: str | None, unique: bool) -> tuple[DataFrame, bool]:
    """Of several rows of one key the one with the highest ``newest_by``; then no key comes twice."""
    return (one_per_key(rows, KEY, newest_by), True) if newest_by else (rows, unique)


class ViewStore:
    """Collections in this session only, behind a temp view of materialised rows."""

    def __init__(self, spark: SparkSession, view: str = "collections"):
        self.spark, self.view = spark, view
        if not spark.catalog.tableExists(view):
            spark.createDataFrame([], COLLECTION_SCHEMA).createOrReplaceTempView(view)

    def read(self, collection_id: str | None = None) -> DataFrame:
        rows = self.spark.table(self.view)
        return rows if collection_id is None else rows.where(F.col("collection_id") == collection_id)

    def insert_missing(self, rows: DataFrame, collection_id: str | None = None, unique: bool = False, newest_by: str | None = None) -> None:
        rows, unique = _newest(finite(rows), newest_by, unique)
        self._replace(insert_missing(self.read(), conform(rows), unique=unique))

    def upsert(self, rows: DataFrame, collection_id: str | None = None, unique: bool = False, newest_by: str | None = None) -> None:
        rows, unique = _newest(finite(rows), newest_by, unique)
        self._replace(upsert(self.read(), conform(rows), unique=unique))

    def _replace(self, rows: DataFrame) -> None:
        cut_lineage(rows).createOrReplaceTempView(self.view)


    def record(self, collection_id: str) -> Record | None:
        """What the rows of a collection agree on; reads one column and the size of another."""
        found = self.read(collection_id).groupBy("collection_id").agg(*_agreed()).first()
        return Record(collection_id, found["embedder"], found["dimension"], ()) if found else None

    def read_many(self, collection_ids: DataFrame) -> DataFrame:
        return self.read().join(collection_ids.distinct(), "collection_id", "left_semi")

    def records(self, collection_ids: DataFrame) -> DataFrame:
        return self.read_many(collection_ids).groupBy("collection_id").agg(*_agreed())


@dataclass(frozen=True)
class Record:
    """One collection: what made its vectors, their size, and the (batch, kind) folders that hold its rows, in order."""

    collection_id: str
    embedder: str | None
    dimension: int | None
    folders: tuple[tuple[int, str], ...]


RECORD_SCHEMA = "version long, embedder string, dimension int, folders array<struct<batch long, kind string>>, collection_id string"


def _agreed() -> list[Column]:
    """Embedder and dimension of a group of rows; rows that do not agree are an error."""
    named = F.coalesce("embedder", F.lit(""))
    width = F.coalesce(F.size("embedding"), F.lit(-1))  # a null array has size -1 or null, by setting
    mixed = F.concat(F.lit("one collection, vectors of "), F.min(named), F.lit(" and "), F.max(named))
    sizes = F.concat(F.lit("one collection, vectors of sizes "), F.min(width).cast("string"), F.lit(" and "), F.max(width).cast("string"))
    return [
        F.when(F.min(named) == F.max(named), F.max("embedder")).otherwise(F.raise_error(mixed)).cast("string").alias("embedder"),
        F.when(F.min(width) == F.max(width), F.when(F.max(width) >= 0, F.max(width))).otherwise(F.raise_error(sizes)).cast("int").alias("dimension"),
    ]


def finite(rows: DataFrame) -> DataFrame:
    """Fail the write on a null vector, or on one with a null, NaN or infinite element, where rows have vectors at all."""
    if "embedding" not in rows.columns:
        return rows
    vector = F.col("embedding").cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    refused = F.raise_error(F.lit("a stored vector has no null, NaN or infinite elements and is not null"))
    return rows.withColumn("embedding", F.when(F.col("embedding").isNotNull() & ~bad, F.col("embedding")).otherwise(refused.cast(rows.schema["embedding"].dataType)))


class ParquetStore:
    """Collections in Parquet below ``root``: one folder per write, partitioned by collection, and a record of each.

    ``add`` batches hold new keys only, ``put`` batches replace rows with the same keys when they are read, ``all``
    batches hold all that a collection has. A write appends its rows and then a record version per collection with its
    embedder, dimension and live batches; what no record names does not count, so a lost job leaves nothing half done.
    A read opens the record of its collection and the folders named there. One writer at a time, as the job key ensures.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- records ---

    def _record_rows(self) -> DataFrame | None:
        if not self._children(f"{self.root}/record"):
            return None
        return self.spark.read.schema(RECORD_SCHEMA).parquet(f"{self.root}/record")

    @staticmethod
    def _newest(rows: DataFrame) -> DataFrame:
        row = F.max(F.struct("version", "embedder", "dimension", "folders")).alias("r")
        return rows.groupBy("collection_id").agg(row).select("collection_id", "r.embedder", "r.dimension", "r.folders")

    def record(self, collection_id: str) -> Record | None:
        """The newest record of one collection: only its own folder of records is opened."""
        folder = f"{self.root}/record/collection_id={self._escaped(collection_id)}"
        if not self._children(folder):
            return None
        schema = RECORD_SCHEMA.rsplit(", collection_id", 1)[0]
        found = self.spark.read.schema(schema).parquet(folder).orderBy(F.desc("version")).first()
        return found and Record(collection_id, found["embedder"], found["dimension"], tuple((f["batch"], f["kind"]) for f in found["folders"]))

    def records(self, collection_ids: DataFrame) -> DataFrame:
        """``collection_id, embedder, dimension, folders`` of the collections named that exist."""
        rows = self._record_rows()
        if rows is None:
            return self.spark.createDataFrame([], RECORD_SCHEMA).drop("version")
        return self._newest(rows.join(collection_ids.distinct(), "collection_id", "left_semi"))

    # --- reading ---

    def read(self, collection_id: str | None = None) -> DataFrame:
        if collection_id is not None:
            record = self.record(collection_id)
            return self._open([record] if record else [])
        rows = self._record_rows()
        return self._open(self._collected(self._newest(rows)) if rows is not None else [])

    def read_many(self, collection_ids: DataFrame) -> DataFrame:
        """The rows of the collections named; folders of others are not opened."""
        return self._open(self._collected(self.records(collection_ids)))

    @staticmethod
    def _collected(records: DataFrame) -> list[Record]:
        """A row for each collection to be opened, as Spark's own listing of their folders has."""
        return [Record(r["collection_id"], None, None, tuple((f["batch"], f["kind"]) for f in r["folders"])) for r in records.collect()]

    def _open(self, records: list[Record]) -> DataFrame:
        paths = [self._folder(batch, kind, r.collection_id) for r in records for batch, kind in r.folders]
        if not paths:
            return self.spark.createDataFrame([], COLLECTION_SCHEMA)
        rows = self._rows(paths)
        puts = [self._folder(batch, kind, r.collection_id) for r in records for batch, kind in r.folders[1:] if kind == "put"]
        if puts:
            # a row counts unless a later batch puts its key: keys of those batches only are joined
            later = self._rows(puts).groupBy(*KEY).agg(F.max("batch").alias("put"))
            rows = rows.join(later, KEY, "left").where("put is null or batch >= put")
        return rows.select(*COLLECTION_SCHEMA.names)

    def _rows(self, paths: list[str]) -> DataFrame:
        rows = self.spark.read.schema(StructType([*COLLECTION_SCHEMA, StructField("batch", StringType())]))
        return rows.option("basePath", self.root).parquet(*paths)

    def _folder(self, batch: int, kind: str, collection_id: str) -> str:
        return f"{self.root}/batch={batch:09d}-{kind}/collection_id={self._escaped(collection_id)}"

    def _escaped(self, name: str) -> str:
        return self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(name)

    # --- writing ---

    def insert_missing(self, rows: DataFrame, collection_id: str | None = None, unique: bool = False, newest_by: str | None = None) -> None:
        """``collection_id`` says that all rows belong to it, so only its folders are compared with;
        ``unique`` that no (collection, id) comes twice; ``newest_by`` names the column whose highest value wins
        where one does."""
        rows, unique = _newest(finite(rows), newest_by, unique)
        self._append(missing_rows(self.read(collection_id), conform(rows), unique=unique), "add")

    def upsert(self, rows: DataFrame, collection_id: str | None = None, unique: bool = False, newest_by: str | None = None) -> None:
        """Appends the rows as a newer version of their keys; stored rows are neither read nor written again."""
        rows, unique = _newest(finite(rows), newest_by, unique)
        self._append(conform(rows) if unique else conform(one_per_key(conform(rows), KEY)), "put")

    def compact(self, collection_ids: DataFrame | None = None) -> None:
        """Write what each of the collections holds now as one batch, all of them unless some are named. Older batches
        stay on disk for readers that have opened them; no record names them any more."""
        self._append(self.read() if collection_ids is None else self.read_many(collection_ids), "all")

    def _append(self, rows: DataFrame, kind: str) -> None:
        number = max((int(n.removeprefix("batch=").split("-")[0]) for n, _ in self._children(self.root) if n.startswith("batch=")), default=0) + 1
        # AQE splits a large collection over tasks and packs small ones together, so files are neither
        # one per task and collection nor one per collection
        folder = f"{self.root}/batch={number:09d}-{kind}"
        rows.hint("rebalance", "collection_id").write.partitionBy("collection_id").parquet(folder)
        if not any(name.startswith("collection_id=") for name, _ in self._children(folder)):
            self._delete(folder)  # nothing was new
            if not self._children(self.root):
                self._delete(self.root)
            return
        try:
            self._note(folder, number, kind)
        except Exception:
            self._delete(folder)
            raise

    def _note(self, folder: str, number: int, kind: str) -> None:
        """A new record version for every collection of a batch, or an error where it does not fit what is recorded."""
        written = self.spark.read.schema(COLLECTION_SCHEMA).option("basePath", folder).parquet(folder)
        new = cut_lineage(written.groupBy("collection_id").agg(*_agreed()))
        old = self.records(new.select("collection_id")).withColumnsRenamed({c: f"old_{c}" for c in ("embedder", "dimension", "folders")})
        both = new.join(old, "collection_id", "left")
        same = F.col("old_folders").isNull() | (F.col("embedder").eqNullSafe(F.col("old_embedder")) & F.col("dimension").eqNullSafe(F.col("old_dimension")))
        told = [F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in ("old_embedder", "old_dimension", "embedder", "dimension")]
        refused = F.raise_error(F.format_string("collection %s was embedded with %s (%s), not with %s (%s)", "collection_id", *told))
        here = F.array(F.struct(F.lit(number).cast("long").alias("batch"), F.lit(kind).alias("kind")))
        folders = here if kind == "all" else F.concat(F.coalesce("old_folders", F.array().cast("array<struct<batch: bigint, kind: string>>")), here)
        checked = F.when(same, F.lit(number).cast("long")).otherwise(refused.cast("long"))
        rows = both.select(checked.alias("version"), "embedder", "dimension", folders.alias("folders"), "collection_id")
        # few narrow rows: one task writes them, a file for each collection
        cut_lineage(rows).coalesce(1).write.mode("append").partitionBy("collection_id").parquet(f"{self.root}/record")

    def _children(self, path: str) -> list[tuple[str, str]]:
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(target):
            return []
        return [(s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(target)]

    def _delete(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def open_store(spark: SparkSession, path: str | None = None) -> ParquetStore | ViewStore:
    """A given path keeps the collections in Parquet; without one they last as long as the session."""
    return ParquetStore(spark, path) if path else ViewStore(spark)


def check_embedder(rows: DataFrame, name: str) -> None:
    """Refuse rows or records of another embedder, unnamed ones too. Reads one column, up to a first mismatch."""
    other = rows.where(~F.col("embedder").eqNullSafe(F.lit(name))).select("embedder").limit(1).collect()
    if other:
        raise ValueError(f"collection was embedded with {other[0]['embedder']!r}, not with {name!r}")


def check_record(record: Record | None, name: str, dimension: int | None = None) -> None:
    """Refuse a collection of another embedder or dimension by its record; one that is not there fits all."""
    if record is None:
        return
    if record.embedder != name:
        raise ValueError(f"collection was embedded with {record.embedder!r}, not with {name!r}")
    if dimension is not None and record.dimension not in (None, dimension):
        raise ValueError(f"collection holds vectors of {record.dimension} values, not of {dimension}")
