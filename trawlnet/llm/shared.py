"""Helpers of the training-data operators: written tables, skew-proof joins, clash-free column names."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawlnet.session import scratch_path

#: A key with more rows than this is dealt to several tasks, so many rows to each, up to SLICES tasks.
SLICE_ROWS = 2_000
SLICES = 1_024
#: So many of the hottest keys are dealt out; the list of them is broadcast, so it has to be bounded.
HOT_KEYS = 1_000


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: computed once, safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    if (made := _MADE.get()) is not None:
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)
#: Lists are collected in a hash table of up to so many keys a task, instead of 128; with more keys they are sorted.
_PASSING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "16384",
}


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Inside, the paths that ``written`` makes are listed, and shuffle files go as soon as the job that made them is done.

    For operators of many steps, which write every step: what the driver has not collected yet would add up on disk.
    """
    before, made = {k: spark.conf.get(k, None) for k in _PASSING}, []
    token = _MADE.set(made)
    for k, v in _PASSING.items():
        spark.conf.set(k, v)
    try:
        yield made
    finally:
        _MADE.reset(token)
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def spent(spark: SparkSession, paths: list[str]) -> None:
    """Deletes tables of ``written`` that nothing reads any more, and takes them off the list."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    paths.clear()


def as_text(column: Column) -> Column:
    """The text of a column, a null being an empty text."""
    return F.coalesce(column.cast("string"), F.lit(""))


def text_bytes(column: Column) -> Column:
    """UTF-8 bytes of a text as a long."""
    return F.octet_length(column).cast("long")


def digest(column: Column) -> Column:
    """SHA-256 of a text as 32 bytes."""
    return F.unhex(F.sha2(column.cast("binary"), 256))


def spread_join(big: DataFrame, small: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``big`` joined with ``small``, which holds each ``key`` once, when some keys fill much of ``big``.

    The hottest keys are counted first (partial sums, so no task sees all rows of a key). Their rows in
    ``big`` go to several tasks by a hash of the whole row; their one row in ``small`` is repeated for
    each of those. All other keys are shuffled as they are. Null keys match nothing and are spread too.
    """
    hot = (
        big.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > SLICE_ROWS)
        .orderBy(F.desc("_rows"), key)
        .limit(HOT_KEYS)
        .select(key, F.least(F.ceil(F.col("_rows") / SLICE_ROWS), F.lit(SLICES)).cast("int").alias("_slices"))
    )
    hot = F.broadcast(hot)
    slices = F.when(F.col(key).isNull(), F.lit(SLICES)).otherwise(F.coalesce(F.col("_slices"), F.lit(1)))
    row = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), slices).cast("int")
    left = big.join(hot, key, "left").withColumn("_slice", row).drop("_slices")
    right = (
        small.join(hot, key, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1)))
        .drop("_slices")
    )
    return left.join(right, [key, "_slice"], how).drop("_slice")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, on any file system that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
