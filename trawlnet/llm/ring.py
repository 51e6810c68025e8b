"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions only."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trawlnet.llm.shared import as_text, text_bytes, written

#: The ring is cut into 2**CELL_BITS cells; virtual nodes stand on their edges, and keys are ranked within a cell.
CELL_BITS = 16
POSITION_BITS = 63


@dataclass(frozen=True)
class Ring:
    """``slack`` 0 gives every shard its exact share, counts at most one apart; above it a shard takes up to
    (1 + slack) times the mean, and fewer keys move when shards come or go."""

    shards: int = 8
    virtual_nodes: int = 128
    slack: float = 0.0

    def nodes(self) -> list[tuple[int, int]]:
        """``(cell, shard)`` of every virtual node, clockwise; a cell that is asked for twice goes to the lower name."""
        taken: dict[int, tuple[str, int]] = {}
        for shard in range(self.shards):
            for i in range(self.virtual_nodes):
                name = f"{shard}/{i}"
                cell = int.from_bytes(hashlib.sha256(name.encode()).digest()[:8], "big") >> (64 - CELL_BITS)
                taken[cell] = min(taken.get(cell, (name, shard)), (name, shard))
        return [(cell, taken[cell][1]) for cell in sorted(taken)]

    def capacities(self, home: list[int]) -> list[int]:
        """Most keys of each shard; without slack the shards with most keys of their own take the odd ones."""
        total = sum(home)
        if self.slack > 0:
            return [ceil((1 + self.slack) * total / self.shards)] * self.shards
        extra = sorted(range(self.shards), key=lambda s: (-home[s], s))[: total % self.shards]
        return [total // self.shards + (s in extra) for s in range(self.shards)]


def place(ring: Ring, owners: list[int], counts: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Where the keys of each arc go: ``(arc, low, high, shard, slot)`` for its keys ranked from low to high - 1.

    Every virtual node first takes the keys of its own arc while its shard has room; the others go on to the next node
    clockwise, again and again. This works on the counts of the arcs, one for each virtual node, whatever the data.
    """
    home = [0] * ring.shards
    for owner, n in zip(owners, counts, strict=True):
        home[owner] += n
    room, slots, out = ring.capacities(home), [0] * ring.shards, []
    waiting = [[(arc, 0, n)] if n else [] for arc, n in enumerate(counts)]
    while any(waiting):
        onward: list[list] = [[] for _ in owners]
        for node, queue in enumerate(waiting):
            shard = owners[node]
            for arc, low, high in queue:
                taken = min(high - low, room[shard])
                if taken:
                    out.append((arc, low, low + taken, shard, slots[shard]))
                    room[shard] -= taken
                    slots[shard] += taken
                if low + taken < high:
                    onward[(node + 1) % len(owners)].append((arc, low + taken, high))
        waiting = onward
    return out


def _position(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit("ring"), key), 64 - POSITION_BITS)


def assign(docs: DataFrame, ring: Ring = Ring(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row; slots of a shard run from 0 without a gap.

    A document stands on the ring at the hash of its id, its size is its UTF-8 bytes plus 1. Only the number of keys
    on each arc reaches the driver; ranks are taken within cells of a 65,536th of the ring, so no task holds an arc
    or a shard. A null id stands where its text's checksum and size put it; a null text has 0 bytes and checksum 0.
    Rows that repeat an id share a place on the ring and may part where a shard fills up; equal rows are
    interchangeable. Other columns are ignored; an empty table gives no rows.
    """
    spark, text = docs.sparkSession, as_text(F.col(text_col))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (text_bytes(text) + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    nameless = F.concat_ws("/", "text_crc32", "size")
    at = _position(F.coalesce(F.col("doc_id").cast("string"), nameless))
    cell = F.shiftrightunsigned(at, POSITION_BITS - CELL_BITS)
    rows = written(rows.withColumn("at", at).withColumn("cell", cell.cast("int")), "ring-keys")

    nodes = ring.nodes()
    stops = [c for c, _ in nodes]
    spans = [(i, low + 1, high) for i, (low, high) in enumerate(zip([-1, *stops], stops, strict=False))]
    # past the last node the ring starts over; an arc's cells are listed, all 65,536 of them at most
    spans = spark.createDataFrame([s for s in [*spans, (0, stops[-1] + 1, (1 << CELL_BITS) - 1)] if s[1] <= s[2]], "arc int, low int, high int")
    arcs = spans.select("arc", F.explode(F.sequence("low", "high")).alias("cell"))
    cells = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(arcs), "cell")
    cells = written(cells, "ring-cells")
    in_arc = Window.partitionBy("arc").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("n").over(in_arc), F.lit(0)))

    found = {r["arc"]: r["n"] for r in cells.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    plan = place(ring, [s for _, s in nodes], [found.get(a, 0) for a in range(len(nodes))])
    columns = "arc int, low long, high long, shard int, first long"
    plan = spark.createDataFrame(plan, columns)

    in_cell = Window.partitionBy("cell").orderBy("at", "doc_id", "size", "text_crc32")
    ranked = rows.withColumn("rank", F.row_number().over(in_cell) - 1)
    # 65,536 cells and one segment for each node and change of shard at most: both are bounded by the ring
    ranked = ranked.join(F.broadcast(cells.select("cell", "arc", "before")), "cell")
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before"))
    placed = ranked.join(F.broadcast(plan), "arc").where("rank >= low and rank < high")
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("rank") - F.col("low")).alias("slot"))
