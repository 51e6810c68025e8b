"""Merkle manifest of a dataset: a digest tree per source, one root over all of them, and a proof for every row.

Every level is one equijoin of nodes with computed sibling indices: the row in slot zero of a run names the places of
its siblings by offset, and once those have joined it emits the parent. Only the root reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawlnet.functions.keys import with_ordinal
from trawlnet.llm.shared import spread_join, written

#: Characters of a digest in hex.
HEX = 64


@dataclass(frozen=True)
class Manifest:
    """``arity`` nodes make a run, a power of two or not; ``fields`` of a row are hashed in this order."""

    arity: int = 16
    id_col: str = "doc_id"
    source_col: str = "source"
    text_col: str = "text"
    fields: tuple[str, ...] = field(default=("doc_id", "source", "lang", "n_chars", "text"))


def length_prefixed(value: Column) -> Column:
    """``-`` for a null, else its UTF-8 bytes counted, a colon and the value, so that fields cannot run together."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(spec: Manifest, text: Column) -> Column:
    """The leaf of a row whose text is ``text``."""
    values = [text if name == spec.text_col else F.col(f"`{name}`") for name in spec.fields]
    return F.sha2(F.concat(*[length_prefixed(v) for v in values]), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to: at each step the digest goes back between those of its siblings."""

    def step(digest: Column, at: Column) -> Column:
        gap = at["slot"] * HEX
        before, after = F.substr(at["others"], F.lit(1), gap), F.substr(at["others"], gap + 1)
        return F.sha2(F.concat(before, digest, after), 256)

    return F.aggregate(path, leaf, step)


def _grow(nodes: DataFrame, arity: int, payload: tuple[str, ...], name: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """Runs of every level, lowest first, and the nodes that are the last of their tree at each level.

    ``nodes`` has ``tree, place, n, digest`` and the columns ``payload``; ``n`` counts the nodes of a tree. A run has
    the columns of a node of the next level and ``children``, its nodes in order.
    """
    runs, tops = [], [nodes.where("n = 1")]
    while (most := nodes.agg(F.max("n")).first()[0]) and most > 1:
        live = nodes.where("n > 1")
        # slot zero asks for every offset that the tree still has, its own included
        last = F.least(F.lit(arity - 1).cast("long"), F.col("n") - 1 - F.col("place"))
        asked = live.where(F.col("place") % arity == 0)
        asked = asked.select("tree", "n", F.col("place").alias("head"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("slot"))
        asked = asked.select("tree", "n", "head", (F.col("head") + F.col("slot")).alias("place"))
        siblings = asked.join(live.drop("n"), ["tree", "place"])
        # at most ``arity`` rows each
        run = siblings.groupBy("tree", "head", "n").agg(F.array_sort(F.collect_list(F.struct("place", "digest", *payload))).alias("children"))
        run = run.select(
            "tree",
            F.expr(f"head div {arity}").alias("place"),
            F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            F.sha2(F.array_join("children.digest", ""), 256).alias("digest"),
            "children",
        )
        runs.append(written(run, f"{name}-{len(runs)}"))
        nodes, payload = runs[-1].drop("children"), ()
        tops.append(nodes.where("n = 1"))
    return runs, tops


def _descend(runs: list[DataFrame], tops: list[DataFrame], above: DataFrame, payload: tuple[str, ...], name: str) -> DataFrame:
    """The lowest nodes, ``digest`` and ``payload``, with their ``path`` and the other columns of ``above``.

    ``above`` has ``tree, path`` of each whole tree. A path lists, from a node upwards, its slot and the digests of its
    siblings in order. Each level joins runs with their own paths, so what is long is copied once per run.
    """
    carried = [c for c in above.columns if c != "tree"]
    paths = tops[-1].join(above, "tree").select("tree", "place", *carried, *([] if runs else ["digest", *payload]))
    for depth in range(len(runs) - 1, -1, -1):
        keep = ("digest", *payload) if depth == 0 else ()
        below = runs[depth].select("tree", "place", "children").join(paths, ["tree", "place"])
        below = below.withColumn("every", F.array_join("children.digest", ""))
        below = below.select("tree", "every", *carried, F.posexplode("children").alias("slot", "node"))
        at = F.col("slot") * HEX
        others = F.concat(F.substr("every", F.lit(1), at), F.substr("every", at + HEX + 1))
        step = F.array(F.struct(F.col("slot"), others.alias("others")))
        up = [F.concat(step, "path").alias(c) if c == "path" else F.col(c) for c in carried]
        below = below.select("tree", F.col("node.place").alias("place"), *up, *[F.col(f"node.{c}").alias(c) for c in keep])
        # trees that end here start with what is above them
        ended = tops[depth].join(above, "tree").select("tree", "place", *carried, *keep)
        paths = below.unionByName(ended)
        paths = written(paths, f"{name}-paths-{depth}") if depth else paths
    return paths


def manifest(docs: DataFrame, spec: Manifest = Manifest(), observed: Callable[[Column], Column] = lambda text: text) -> DataFrame:
    """``id, leaf, subroot, root, path, observed_leaf`` of every row of ``docs``.

    Leaves of a source ascend by id; while a source has several nodes, each run of ``arity`` becomes their digest. What
    is left is its subroot; the subroots, by source, are the leaves of the tree above. ``path`` holds a row's siblings
    up to the root: ``folded(leaf, path)`` is the root again. ``observed`` makes the text to be held against the
    manifest of the text column, and ``observed_leaf`` is the leaf with it.

    A null source is a source of its own, before the others; null ids come first in their source; rows with equal ids
    are ordered by their leaf, so equal rows in any order give the same digests. Null fields are told from empty ones;
    columns that are not in ``fields`` are ignored. An empty table gives no rows.
    """
    text = F.col(f"`{spec.text_col}`")
    seen = observed(text)
    leaf = row_digest(spec, text)
    source = F.col(f"`{spec.source_col}`").cast("string")
    leaves = docs.select(
        source.alias("source"),
        F.col(f"`{spec.id_col}`").alias("id"),
        leaf.alias("digest"),
        F.when(~seen.eqNullSafe(text), row_digest(spec, seen)).alias("observed"),
        # parts equal rows, so that many of them need not be sorted by one task
        F.monotonically_increasing_id().alias("tie"),
    )
    numbered = with_ordinal(leaves, ["source", "id", "digest", "tie"])
    numbered = numbered.withColumn("named", F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))).drop("tie", "source")
    # a tree is named by the number of its first leaf, which keeps the trees in the order of their sources
    trees = written(numbered.groupBy("named").agg(F.min("ordinal").alias("tree"), F.count(F.lit(1)).alias("n")), "trees")
    nodes = spread_join(numbered, trees, "named").withColumn("place", F.col("ordinal") - F.col("tree")).drop("named", "ordinal")
    nodes = written(nodes, "leaves")

    payload = ("id", "observed")
    runs, tops = _grow(nodes, spec.arity, payload, "runs")
    subroots = reduce(DataFrame.unionByName, [t.select("tree", "digest") for t in tops])
    subroots = with_ordinal(subroots.withColumnsRenamed({"tree": "source_tree"}), ["source_tree"], "place")
    n_trees = trees.count()
    subroots = written(subroots.select(F.lit(0).cast("long").alias("tree"), "place", F.lit(n_trees).cast("long").alias("n"), "digest", "source_tree"), "subroots")
    top_runs, top_tops = _grow(subroots, spec.arity, ("source_tree",), "top-runs")
    last = top_tops[-1].select("digest").first()
    root = F.lit(last["digest"] if last else None).cast("string")

    start = F.array().cast("array<struct<slot int, others string>>")
    above = docs.sparkSession.range(1).select(F.col("id").alias("tree"), start.alias("path"))
    whole = _descend(top_runs, top_tops, above, ("source_tree",), "top")
    whole = written(whole.select(F.col("source_tree").alias("tree"), "path", F.col("digest").alias("subroot")), "tree-paths")
    out = _descend(runs, tops, whole, payload, "node")
    return out.select(
        F.col("id").alias(spec.id_col),
        F.col("digest").alias("leaf"),
        "subroot",
        root.alias("root"),
        "path",
        F.coalesce("observed", "digest").alias("observed_leaf"),
    )


def checked(rows: DataFrame) -> DataFrame:
    """The rows of ``manifest`` with ``proof_sha256``, one digest of all siblings of the path in order, with
    ``folded_root``, where the observed leaf and the path lead, and with ``verified``, whether that is the root."""
    proof = F.sha2(F.array_join("path.others", ""), 256)
    rows = rows.withColumn("proof_sha256", proof).withColumn("folded_root", folded(F.col("observed_leaf"), F.col("path")))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root")).drop("path", "observed_leaf")
