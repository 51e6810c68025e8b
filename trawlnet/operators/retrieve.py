"""Nearest-neighbour retrieval: exact and approximate top-k joins, nesting and formatting."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from trawlnet.functions.text import first_non_empty
from trawlnet.operators.topk import NearestVectors, RunningTopK, id_ranks, squared_distances, without_spare_copies
from trawlnet.session import cut_lineage

# Hits by default, what separates documents, and the sentence for none.
DEFAULT_K = 5
SEPARATOR = "\n\n---\n\n"
NO_RESULTS = "No results found."

# Queries below both of these are sent to the items; more of them meet the items in a grid of blocks.
BROADCAST_ROWS = 8192
BROADCAST_BYTES = 64 << 20
# Queries in one block of the grid, the items of a part in such blocks (a task reads them slice by slice), cells per core
# at least, and the estimate of a table's size beyond which it is counted.
GRID_BYTES = 64 << 20
PART_BLOCKS = 4
CELLS_PER_CORE = 4
UNKNOWN_BYTES = 1 << 50
# Scopes with their block counts that are broadcast, a few dozen bytes each.
BROADCAST_SCOPES = 200_000
# Rows of either side in one cell block of the partitioned join.
ITEM_BLOCK = 131_072
QUERY_BLOCK = 65_536
# From so many queries on, looking for equal vectors in a batch costs less than scoring the copies.
COPY_CHECK_QUERIES = 64
# Items of a cell scored at once.
_CELL_ITEMS = 8_192
# Scope values that are worth an IN filter on the items.
PRUNED_SCOPES = 1000


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column as a float64 matrix; unequal row sizes and null, NaN or infinite elements are an error."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    n = len(column)
    width = len(flat) // n if n else 0
    if n and (column.value_lengths().to_numpy() != width).any():
        raise ValueError("vectors of different sizes cannot be compared")
    if not np.isfinite(flat).all():  # a null element reads as NaN
        raise ValueError("vectors with null, NaN or infinite elements cannot be compared")
    return flat.reshape(n, width)


def plain(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.to_numpy(zero_copy_only=False)


def knn(
    queries: DataFrame,
    items: DataFrame,
    k: int = DEFAULT_K,
    *,
    query_id: str = "query_id",
    item_id: str = "id",
    vector_col: str = "embedding",
    scope: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The ``k`` nearest items of every query: ``query_id, item_id, distance, rank``, and ``scope`` where it is given.

    Exact for any input size. ``distance`` is squared L2 to 6 decimals, and equal distances rank by
    item id. With ``scope``, a query only meets items with the same value there, and a query id
    that asks several scopes is ranked in each. Null vectors are skipped; null, NaN or infinite
    elements are an error on either side.
    The queries are materialised once, since an embedder need not repeat itself. Few enough of them travel to the
    items, which never move; more of them meet the items in one job, block by block (``_knn_grid``).
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    queries = cut_lineage(_narrow(queries, query_id, vector_col, scope))
    items = _narrow(items, item_id, vector_col, scope)
    size = F.sum(F.size(vector_col).cast("long") * 8 + F.octet_length(F.col(query_id).cast("string")) + 64)
    n_rows, n_bytes = queries.agg(F.count(F.lit(1)), size).first()
    if n_rows <= broadcast_rows and (n_bytes or 0) <= BROADCAST_BYTES:
        field = queries.schema[query_id]
        hits = _knn_broadcast(queries.toArrow(), field, items, k, query_id, item_id, vector_col, scope)
    else:
        hits = _knn_grid(queries, n_rows, n_bytes, items, k, query_id, item_id, vector_col, scope, broadcast_rows)
    return rank_hits(hits, k, query_id, item_id, scope=scope)


def _estimated_bytes(df: DataFrame) -> int:
    """What the optimizer expects of a table's size, from the sizes of its files; very large where it cannot know."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _knn_grid(queries, n_rows, n_bytes, items, k, query_id, item_id, vector_col, scope, broadcast_rows) -> DataFrame:
    """Both sides in a grid of (item part, query block) cells, each of bounded size, in one job.

    An item is copied once per query block, a query once per item part, and a cell keeps the k best of each of its
    queries. Blocks are as large as a task can hold, so copies stay few; smaller tables get cells for every core. Without
    a scope the number of parts follows from the size that the optimizer expects, so the items are scanned once. With one, every scope is a grid of its own, sized by its rows: items meet the queries of their own
    scope only, and those of a scope that no query asks are left out before anything is shuffled.
    """
    width = max(1, n_bytes // n_rows)
    cells = CELLS_PER_CORE * queries.sparkSession.sparkContext.defaultParallelism
    # the k best of each query are held as well
    q_rows = max(1, min(max(broadcast_rows, math.ceil(n_rows / math.sqrt(cells))), GRID_BYTES // (width + 16 * k)))
    x_rows = max(1, PART_BLOCKS * GRID_BYTES // width)
    centre = [r["m"] for r in queries.select(F.posexplode(vector_col).alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m")).orderBy("i").collect()]
    block = F.xxhash64(query_id)
    part = F.xxhash64(item_id, vector_col)
    if scope:
        asked = queries.groupBy(scope).agg(F.ceil(F.count(F.lit(1)) / q_rows).alias("_nq"))
        asked = cut_lineage(asked)
        n_scopes = asked.count()
        if n_scopes <= PRUNED_SCOPES:  # lets a table partitioned by the scope skip whole folders
            items = items.where(F.col(scope).isin([r[scope] for r in asked.collect() if r[scope] is not None]))
        held = items.groupBy(scope).agg(F.ceil(F.count(F.lit(1)) / x_rows).alias("_ni"))
        parts = cut_lineage(asked.join(held, scope))
        parts = F.broadcast(parts) if n_scopes <= BROADCAST_SCOPES else parts
        queries, items = queries.join(parts, scope), items.join(parts, scope)
    else:
        expected = _estimated_bytes(items)
        part_bytes = PART_BLOCKS * GRID_BYTES
        n_parts = math.ceil(expected / part_bytes) if expected < UNKNOWN_BYTES else math.ceil(items.count() / x_rows)
        n_blocks = math.ceil(n_rows / q_rows)
        n_parts = max(1, n_parts, math.ceil(cells / n_blocks))
        counts = {"_nq": F.lit(n_blocks), "_ni": F.lit(n_parts)}
        queries, items = queries.withColumns(counts), items.withColumns(counts)
    keys = [*([scope] if scope else []), "_ip", "_qb"]
    n_cells = None if scope else n_blocks * n_parts

    def numbers(n: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1))

    own = [scope] if scope else []
    q = queries.select(query_id, F.col(vector_col).alias("_qv"), *own, F.pmod(block, F.col("_nq").cast("long")).alias("_qb"), numbers("_ni").alias("_ip"))
    x = items.select(item_id, F.col(vector_col).alias("_xv"), *own, F.pmod(part, F.col("_ni").cast("long")).alias("_ip"), numbers("_nq").alias("_qb"))
    schema = _hit_schema(items, queries.schema[query_id], item_id, scope)

    def best_of_cell(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema_of(left, right).empty_table()
        middle = np.asarray(centre)
        ranks, ids = id_ranks(right[item_id].combine_chunks())
        top = NearestVectors(matrix(left["_qv"]) - middle, k)
        for low in range(0, right.num_rows, _CELL_ITEMS):
            top.offer(matrix(right["_xv"].slice(low, _CELL_ITEMS)) - middle, ranks[low : low + _CELL_ITEMS])
        rows, found, costs = top.best()
        rows = pa.array(rows)
        scopes = [left[scope].combine_chunks().take(rows)] if scope else []
        made = [left[query_id].combine_chunks().take(rows), *scopes, ids.take(pa.array(found)), pa.array(costs)]
        return pa.Table.from_arrays(made, names=schema.names)

    def schema_of(left: pa.Table, right: pa.Table) -> pa.Schema:
        fields = [left.schema.field(query_id), *([left.schema.field(scope)] if scope else []), right.schema.field(item_id)]
        return pa.schema([*fields, pa.field("distance", pa.float64())])

    if n_cells is not None:  # few cells share a task, however small their rows are
        q, x = q.repartition(2 * n_cells, *keys), x.repartition(2 * n_cells, *keys)
    return q.groupBy(*keys).cogroup(x.groupBy(*keys)).applyInArrow(best_of_cell, schema)


def _narrow(df: DataFrame, key: str, vector_col: str, scope: str | None) -> DataFrame:
    columns = [F.col(key), F.col(vector_col)] + ([F.col(scope)] if scope else [])
    return df.select(*columns).where(F.col(vector_col).isNotNull())


def rank_hits(hits: DataFrame, k: int, query_id: str, item_id: str, cost: str = "distance", scope: str | None = None) -> DataFrame:
    """Merge partial top-k lists, one per query and task. Spark also keeps k per query in each partition up to k = 1000."""
    order = Window.partitionBy(query_id, *([scope] if scope else [])).orderBy(cost, item_id)
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _hit_schema(items: DataFrame, query_field: StructField, item_id: str, scope: str | None = None) -> StructType:
    return StructType(
        [
            StructField(query_field.name, query_field.dataType),
            *([StructField(scope, items.schema[scope].dataType)] if scope else []),
            StructField(item_id, items.schema[item_id].dataType),
            StructField("distance", DoubleType()),
        ]
    )


def _knn_broadcast(head: pa.Table, query_field, items, k, query_id, item_id, vector_col, scope) -> DataFrame:
    """Items stay where they are: every task scores its batches and emits at most k rows per query."""
    schema = _hit_schema(items, query_field, item_id, scope)
    ids = head[query_id].combine_chunks()
    asked = head[scope].combine_chunks() if scope else None
    vectors = matrix(head[vector_col])
    # distances do not change when both sides move; near the origin their sums cancel less
    centre = vectors.mean(axis=0) if len(vectors) else np.zeros(0)
    members: dict | None = None
    if scope:
        values = pd.Series(plain(head[scope]))
        members = {value: np.asarray(rows) for value, rows in values.groupby(values).indices.items()}
        if len(members) <= PRUNED_SCOPES:  # lets a table partitioned by the scope skip whole folders
            items = items.where(F.col(scope).isin(values.dropna().unique().tolist()))
    shared = items.sparkSession.sparkContext.broadcast((ids, vectors - centre, members, centre, asked))

    def score(batches):
        q_ids, q, by_scope, middle, q_scopes = shared.value
        best = RunningTopK(len(q_ids), k)
        item_type = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x, x_ids = matrix(batch.column(vector_col)), plain(batch.column(item_id))
            item_type = batch.schema.field(item_id).type
            if not len(q):
                continue
            x = x - middle
            if by_scope is None:
                if len(q) >= COPY_CHECK_QUERIES:
                    x, x_ids = without_spare_copies(x, x_ids, k)
                best.offer(lambda part, x=x: squared_distances(q[part], x), len(x), x_ids)
                continue
            for value, rows in pd.Series(np.arange(len(x))).groupby(plain(batch.column(scope))):
                if value in by_scope:
                    sub, sub_ids = x[rows.to_numpy()], x_ids[rows.to_numpy()]
                    if len(by_scope[value]) >= COPY_CHECK_QUERIES:
                        sub, sub_ids = without_spare_copies(sub, sub_ids, k)
                    best.gather(lambda part, x=sub: squared_distances(q[part], x), len(sub), sub_ids, by_scope[value])
            best.merge()
        if best.ids is not None and len(best.rows):
            rows = pa.array(best.rows)
            scopes = [q_scopes.take(rows)] if q_scopes is not None else []
            yield pa.RecordBatch.from_arrays(
                [q_ids.take(rows), *scopes, pa.array(best.ids, type=item_type), pa.array(best.costs)], names=schema.names
            )

    return items.mapInArrow(score, schema)


def once_per_vector(queries, items, k, query_id, item_id, vector_col, join) -> DataFrame:
    """Run ``join`` on distinct vectors, then hand each answer to all queries with that vector.

    Of items with equal vectors only the k lowest ids can be hits; queries with equal vectors share
    one answer, found by the id of the one that asks for all of them.
    """
    lowest = Window.partitionBy(vector_col).orderBy(item_id)
    items = items.withColumn("_copy", F.row_number().over(lowest)).where(F.col("_copy") <= k).drop("_copy")
    # both are read several times by the join, and may hold vectors that were costly to make
    queries, items = cut_lineage(queries), cut_lineage(items)
    askers = cut_lineage(queries.groupBy(vector_col).agg(F.min(query_id).alias(query_id)))
    placed = queries.join(askers.withColumnRenamed(query_id, "_asker"), vector_col).select(query_id, "_asker")
    hits = rank_hits(join(askers, items), k, query_id, item_id)
    lists = hits.groupBy(F.col(query_id).alias("_asker")).agg(F.collect_list(F.struct(item_id, "distance", "rank")).alias("_hits"))  # k each
    return placed.join(lists, "_asker").select(query_id, F.inline("_hits"))


def block_join(visits, placed, sizes, *, k, query_id, item_id, vector_col) -> DataFrame:
    """Top-k of each visiting query within its cell, as (cell, item part, query part) blocks.

    Parts are sized from the counts of both sides, so a cell holding a third of all rows becomes
    many bounded groups; a block emits k rows per query, never its pairs.
    """
    spark = visits.sparkSession
    visitors = {r["cell"]: r["count"] for r in visits.groupBy("cell").count().collect()}  # one row per cell
    plan = [
        (int(c), max(1, math.ceil(int(sizes[c]) / ITEM_BLOCK)), max(1, math.ceil(n / QUERY_BLOCK)))
        for c, n in visitors.items()
    ]
    parts = F.broadcast(spark.createDataFrame(plan, "cell int, _ni int, _nq int"))  # bounded by the cell count
    q = visits.join(parts, "cell").select(
        query_id,
        F.col(vector_col).alias("_qv"),
        "cell",
        F.pmod(F.xxhash64(query_id), F.col("_nq").cast("long")).alias("_qp"),
        F.explode(F.sequence(F.lit(0), F.col("_ni") - 1)).alias("_ip"),
    )
    x = placed.join(parts, "cell").select(
        item_id,
        F.col(vector_col).alias("_xv"),
        "cell",
        F.pmod(F.xxhash64(item_id), F.col("_ni")).cast("int").alias("_ip"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_nq").cast("long") - 1)).alias("_qp"),
    )
    schema = _hit_schema(placed, visits.schema[query_id], item_id)

    def best_of_block(left: pa.Table, right: pa.Table) -> pa.Table:
        ranks, ids = id_ranks(right[item_id].combine_chunks())
        top = NearestVectors(matrix(left["_qv"]), k)
        for low in range(0, right.num_rows, _CELL_ITEMS):
            top.offer(matrix(right["_xv"].slice(low, _CELL_ITEMS)), ranks[low : low + _CELL_ITEMS])
        rows, found, costs = top.best()
        made = [left[query_id].combine_chunks().take(pa.array(rows)), ids.take(pa.array(found)), pa.array(costs)]
        return pa.Table.from_arrays(made, names=schema.names)

    keys = ["cell", "_ip", "_qp"]
    return q.groupBy(*keys).cogroup(x.groupBy(*keys)).applyInArrow(best_of_block, schema)


# --- approximate -----------------------------------------------------------------------------


def knn_approximate(
    queries: DataFrame,
    items: DataFrame,
    k: int = DEFAULT_K,
    *,
    query_id: str = "query_id",
    item_id: str = "id",
    vector_col: str = "embedding",
    tables: int = 4,
    bucket_length: float = 1.0,
    cells_per_table: int = 512,
) -> DataFrame:
    """Top-k among items that share a random-projection bucket with the query in any of ``tables``.

    Buckets fold into a fixed number of cells, so the cell statistics stay bounded; folding only
    adds candidates. Distances are exact; some true neighbours can be missing.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector, vector_to_array

    lsh = BucketedRandomProjectionLSH(
        inputCol="_v", outputCol="_h", bucketLength=bucket_length, numHashTables=tables, seed=7
    )

    def in_cells(df: DataFrame, key: str) -> DataFrame:
        buckets = model.transform(as_vectors(df, key))
        cells = [
            F.pmod(F.xxhash64(vector_to_array(F.element_at("_h", t + 1))), F.lit(cells_per_table)) + t * cells_per_table
            for t in range(tables)
        ]
        return buckets.select(key, vector_col, F.explode(F.array(*cells).cast("array<int>")).alias("cell"))

    def as_vectors(df: DataFrame, key: str) -> DataFrame:
        return _narrow(df, key, vector_col, None).withColumn("_v", array_to_vector(F.col(vector_col).cast("array<double>")))

    model = lsh.fit(as_vectors(items, item_id).limit(1))  # random directions: only the dimension is read
    def join(q: DataFrame, x: DataFrame) -> DataFrame:
        placed = in_cells(x, item_id)
        sizes = np.zeros(tables * cells_per_table, dtype=np.int64)
        for r in placed.groupBy("cell").count().collect():  # at most tables * cells_per_table rows
            sizes[r["cell"]] = r["count"]
        hits = block_join(
            in_cells(q, query_id), placed, sizes, k=k, query_id=query_id, item_id=item_id, vector_col=vector_col
        )
        return hits.dropDuplicates([query_id, item_id])

    narrow = (_narrow(queries, query_id, vector_col, None), _narrow(items, item_id, vector_col, None))
    return once_per_vector(*narrow, k, query_id, item_id, vector_col, join)


def recall(found: DataFrame, truth: DataFrame, query_id: str = "query_id", item_id: str = "id") -> DataFrame:
    """Share of the true neighbours that ``found`` holds, over all queries."""
    pairs = truth.select(query_id, item_id).join(
        found.select(query_id, item_id, F.lit(1).alias("_hit")), [query_id, item_id], "left"
    )
    return pairs.agg((F.count("_hit") / F.count("*")).alias("recall"))


# --- shaping results -------------------------------------------------------------------------


def nest_hits(hits: DataFrame, query_id: str = "query_id", fields: Sequence[str] = ("rank", "id", "document", "distance")) -> DataFrame:
    """One row per query with its hits in rank order (at most k structs)."""
    return hits.groupBy(query_id).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("hits"))


def format_hits(documents: Column) -> Column:
    """Join the non-empty documents; a fixed sentence when none are left."""
    kept = F.filter(documents, lambda d: d.isNotNull() & (d != ""))
    return first_non_empty(F.array_join(kept, SEPARATOR), NO_RESULTS)


def context_per_query(queries: DataFrame, hits: DataFrame, query_id: str = "query_id", document: str = "document") -> DataFrame:
    """Formatted context for every query, also those without a hit."""
    documents = hits.groupBy(query_id).agg(
        F.array_sort(F.collect_list(F.struct("rank", document))).alias("_d")
    )
    return queries.join(documents, query_id, "left").select(
        queries["*"], format_hits(F.col(f"_d.{document}")).alias("context")
    )


def with_attachments(hits: DataFrame, attachments: DataFrame) -> DataFrame:
    """Index hits plus attached texts. ``priority`` puts a request's attachments (0) before its hits (1);
    ``rank`` orders each kind. No group is gathered, so any number of attachments is fine."""
    first = attachments.withColumns({"origin": F.lit("attachment"), "priority": F.lit(0)})
    second = hits.withColumns({"origin": F.lit("index"), "priority": F.lit(1)})
    return first.unionByName(second, allowMissingColumns=True)


FETCH_BROADCAST_ROWS = 500_000


def fetch(hits: DataFrame, table: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Hits joined with their rows of ``table``.

    The hits are materialised and counted first: below the bound they go to the table, which then
    is read once and not shuffled; above it both sides shuffle on the key.
    """
    hits = cut_lineage(hits)
    if hits.count() <= FETCH_BROADCAST_ROWS:
        return table.join(F.broadcast(hits), key)
    return hits.join(table, key)
