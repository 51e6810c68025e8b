"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trawlnet.llm.shared import written


def _is_stars(edges: DataFrame) -> bool:
    """Whether every ``a`` has one edge and no ``b`` is an ``a``: then each ``b`` is the lowest node of its component."""
    starts = edges.select(F.col("a").alias("node"), F.lit(1).alias("start"), F.lit(0).alias("end"))
    ends = edges.select(F.col("b").alias("node"), F.lit(0).alias("start"), F.lit(1).alias("end"))
    nodes = starts.union(ends).groupBy("node").agg(F.sum("start").alias("starts"), F.max("end").alias("end"))
    return nodes.where("starts > 1 or (starts = 1 and end = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``; a component is named by its lowest node.

    Repeated links, loops and both directions are fine; a link with a null end is ignored. Each round is a few
    aggregations and one join on a node, whose hubs adaptive execution splits, and is written out; a round brings
    nodes closer to the lowest one, and the loop ends when only stars are left.
    """
    ends = links.where("a is not null and b is not null")
    edges = ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    loops = ends.select(F.col("a").alias("node")).union(ends.select(F.col("b").alias("node")))
    edges = written(edges, "links")
    while not _is_stars(edges):
        # large star: every neighbour above a node moves to the lowest node around it
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        around = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("b"), F.least("low", "a").alias("low"))
        large = edges.join(around, "b").select("a", F.col("low").alias("b")).distinct()
        # small star: a node's lower neighbours, which are few now, and the node itself move to the lowest of them
        lowest = F.min("b").over(Window.partitionBy("a"))
        moves = large.withColumn("low", lowest).select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
        edges = written(moves.where("a <> b").distinct(), "stars")
    named = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return loops.distinct().join(named, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
