"""Stable keys: collection names, job keys, request ids and batch ordinals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawlnet.functions.text import basename
from trawlnet.session import cut_lineage


def collection_name(path: Column) -> Column:
    return F.concat(F.lit("code_"), basename(path))


def name_collisions(projects: DataFrame, path_col: str = "project_path") -> DataFrame:
    """Collection names claimed by more than one project path."""
    return (
        projects.select(path_col)
        .distinct()
        .groupBy(collection_name(F.col(path_col)).alias("collection_id"))
        .agg(F.count("*").alias("n_paths"), F.min(path_col).alias("first_path"), F.max(path_col).alias("last_path"))
        .where("n_paths > 1")
    )


def job_key(path: Column) -> Column:
    return F.concat(F.lit("ingest-"), F.substring(F.sha2(path, 256), 1, 8))


def request_id(given: Column) -> Column:
    """The given id, else sixteen random hex digits; materialise before reading it twice."""
    fresh = F.substring(F.replace(F.uuid(), F.lit("-"), F.lit("")), 1, 16)
    return F.coalesce(F.nullif(given, F.lit("")), fresh)


def with_ordinal(df: DataFrame, order_by: Sequence[str], name: str = "ordinal") -> DataFrame:
    """Number all rows from 0 in the order of ``order_by`` without funnelling them into one task.

    A range sort places whole key ranges in partitions; the sorted rows are checkpointed so that
    the sizes and the numbering see one and the same layout. Only one size per partition reaches
    the driver. Pass narrow rows, keys without texts: they are checkpointed before the sort too,
    because a range sort reads its input twice and making the keys may mean reading all texts.
    """
    spark = df.sparkSession
    placed = cut_lineage(cut_lineage(df).orderBy(*order_by).withColumn("_slot", F.monotonically_increasing_id()))
    partition = F.shiftright("_slot", 33)
    within = F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r["p"]: r["n"] for r in placed.groupBy(partition.alias("p")).agg(F.count("*").alias("n")).collect()}
    rows, total = [], 0
    for p in sorted(sizes):
        rows.append((p, total))
        total += sizes[p]
    # one row per sort partition, so the broadcast is bounded by the shuffle width
    starts = F.broadcast(spark.createDataFrame(rows, "_p long, _start long"))
    return (
        placed.withColumn("_p", partition)
        .join(starts, "_p")
        .withColumn(name, F.col("_start") + within)
        .drop("_slot", "_p", "_start")
    )


def chunk_id(ordinal: Column) -> Column:
    return F.concat(F.lit("chunk_"), ordinal.cast("string"))


def content_key(path: Column, start_line: Column) -> Column:
    """An id that stays with its text when files before it grow."""
    return F.concat_ws(":", path, F.coalesce(start_line.cast("string"), F.lit("0")))
