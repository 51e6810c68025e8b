"""Mixing sources to target weights by temperature, in DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trawlnet.llm.shared import as_text, spread_join, written

#: Exponents tried at once in each narrowing of the bracket, and how often it is narrowed: to 64**-5 of 1.
SECTIONS, NARROWINGS = 64, 5
#: Rows of one source, copy and hash range that one task ranks, about.
RANGE_ROWS = 4_096
#: Source names are broadcast up to this many.
BROADCAST_SOURCES = 100_000


@dataclass(frozen=True)
class Mix:
    """``evenness``: target entropy of the weights as a share of its maximum, the logarithm of the number of sources.
    ``most_copies``: no source is repeated more often on average; it wins where both can't be had. ``budget``: tokens
    to give out; None: the least with which every source is used up once. ``block_tokens``: tokens of a block."""

    evenness: float = 0.9
    most_copies: float = 4.0
    budget: int | None = None
    block_tokens: int = 1_000_000
    seed: int = 11


def word_tokens(text: Column) -> Column:
    """White-space words of a text, and one more for the end of the document."""
    return (F.size(F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")) + 1).cast("long")


def exponent(shares: DataFrame, mix: Mix) -> tuple[float, float]:
    """The exponent of the source shares, and the sum of the shares raised to it; ``shares`` has ``p`` and ``total``.

    With weights p^x / sum(p^x), entropy and repetition both fall as x goes from 0 (even) to 1 (natural). Searched is
    the largest x with the entropy asked for, and the least x within the repetition limit; the larger of the two is
    taken. Each pass evaluates a row of exponents between the brackets, all in one aggregation over the sources.
    """

    def at(points: list[float]) -> dict[float, tuple[float, float, bool]]:
        grid = shares.withColumn("x", F.explode(F.array(*[F.lit(x) for x in points])))
        power = F.pow("p", "x")
        sums = grid.groupBy("x").agg(
            F.sum(power).alias("z"), F.sum(power * F.log("p")).alias("y"),
            F.min("p").alias("least"), F.max("p").alias("most"), F.first("total").alias("total"), F.count(F.lit(1)).alias("n"),
        )
        out = {}
        for r in sums.collect():  # one row for each exponent
            entropy = math.log(r["z"]) - r["x"] * r["y"] / r["z"]
            steep = (r["most"] / r["least"]) ** (1 - r["x"])
            copies = steep if mix.budget is None else mix.budget / r["total"] * r["least"] ** (r["x"] - 1) / r["z"]
            out[r["x"]] = (r["z"], entropy - mix.evenness * math.log(r["n"]), copies <= mix.most_copies * (1 + 1e-12))
        return out

    # brackets: the entropy is enough up to low[0]; the repetition is within its limit from high[1] on
    low, high = [0.0, 0.0], [1.0, 1.0]
    ends = at([0.0, 1.0])
    if ends[1.0][1] >= -1e-12:
        low[0] = 1.0
    if ends[0.0][2]:
        high[1] = 0.0
    for _ in range(NARROWINGS):
        points = sorted({lo + (hi - lo) * i / SECTIONS for lo, hi in zip(low, high, strict=True) for i in range(SECTIONS + 1)})
        seen = at(points)
        enough = [x for x in points if low[0] <= x <= high[0] and seen[x][1] >= -1e-12]
        within = [x for x in points if low[1] <= x <= high[1] and seen[x][2]]
        low[0] = max([low[0], *enough])
        high[0] = min([x for x in points if low[0] < x <= high[0]], default=low[0])
        high[1] = min([high[1], *within])
        low[1] = max([x for x in points if low[1] <= x < high[1]], default=high[1])
    chosen = max(low[0], high[1])
    return chosen, at([chosen])[chosen][0]


def mix_sources(
    docs: DataFrame,
    mix: Mix = Mix(),
    id_col: str = "doc_id",
    source_col: str = "source",
    tokens: Column | None = None,
    content: tuple[str, ...] = ("text",),
) -> DataFrame:
    """The rows of ``docs``, each as often as it is drawn, with ``tokens, copy, block, position``.

    A source's documents follow each other in a new order for each copy, by hash. A document is drawn while the tokens
    before it are within the source's budget, weight times the whole budget, so a source overshoots by less than one
    document; with budget None none is left out. The running tokens also give the block: each block takes every
    source in its target weight. Within a block the order is a permutation by hash, given as ``position`` from 0.

    Running sums are taken within hash ranges of about 4,096 rows, and over the sums of the ranges, so a source that
    fills a third of the table is many tasks. ``tokens`` (default: words of ``text`` plus 1, null being empty) is taken
    to be 1 at least. A null source is a source; null ids are fine; equal rows are interchangeable; an empty table
    gives no rows. Columns of ``docs`` that bear a name of the result give way to it.
    """
    made = ["tokens", "copy", "block", "position"]
    count = word_tokens(as_text(F.col("text"))) if tokens is None else tokens
    keep = [c for c in docs.columns if c not in made and not c.startswith("_mix_")]
    name = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n"))
    row = F.xxhash64(F.lit(mix.seed), F.col(id_col), *[F.col(c) for c in content])
    base = docs.withColumn("_mix_tokens", F.greatest(F.coalesce(count.cast("long"), F.lit(1)), F.lit(1)))
    base = base.withColumn("_mix_source", name).withColumn("_mix_row", row)
    # one narrow pass for the sums: hash, tokens and source of each row
    narrow = written(base.select("_mix_source", "_mix_row", "_mix_tokens"), "mix-rows")
    totals = narrow.groupBy("_mix_source").agg(F.sum("_mix_tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    totals = written(totals, "mix-sources")
    n_sources, total, largest = totals.agg(F.count(F.lit(1)), F.sum("t"), F.max("t")).first()
    if not n_sources:
        empty = [F.lit(0).cast(k).alias(c) for c, k in zip(made, ("long", "int", "long", "long"), strict=True)]
        return docs.select(*keep, *empty).where(F.lit(False))
    shares = totals.select((F.col("t") / F.lit(float(total))).alias("p"), F.lit(float(total)).alias("total"))
    x, z = exponent(shares, mix)
    weight = F.pow(F.col("t") / F.lit(float(total)), F.lit(x)) / F.lit(z)
    budget = F.lit(largest / ((largest / total) ** x / z) if mix.budget is None else float(mix.budget))
    plan = totals.select(
        "_mix_source",
        weight.alias("_mix_weight"),
        # a whole number of copies but for rounding counts as whole
        F.when(F.abs(budget * weight / F.col("t") - F.round(budget * weight / F.col("t"))) < 1e-9, F.round(budget * weight / F.col("t")))
        .otherwise(budget * weight / F.col("t")).alias("_mix_epochs"),
        F.col("t").alias("_mix_total"),
        F.ceil(F.log2(F.greatest(F.col("n") / RANGE_ROWS, F.lit(1.0)))).cast("int").alias("_mix_bits"),
    )
    plan = written(plan, "mix-plan")

    def drawn(rows: DataFrame) -> DataFrame:
        """A row for each copy that may be needed, with its place in the copy's order."""
        if n_sources <= BROADCAST_SOURCES:
            rows = rows.join(F.broadcast(plan), "_mix_source")
        else:
            rows = spread_join(rows, plan, "_mix_source", "inner")
        copies = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil("_mix_epochs").cast("int") - 1, F.lit(0))))
        rows = rows.withColumn("copy", copies)
        rows = rows.withColumn("_mix_at", F.xxhash64("copy", "_mix_row"))
        # Spark shifts by the low 6 bits only: no bits left is one range
        part = F.when(F.col("_mix_bits") == 0, F.lit(0)).otherwise(F.expr("shiftrightunsigned(_mix_at, 64 - _mix_bits)"))
        return rows.withColumn("_mix_range", part.cast("long"))

    spot = ["_mix_source", "copy", "_mix_range"]
    sums = drawn(narrow).groupBy(*spot).agg(F.sum("_mix_tokens").alias("_mix_sum"))
    over = Window.partitionBy("_mix_source").orderBy("copy", "_mix_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(sums.withColumn("_mix_start", F.coalesce(F.sum("_mix_sum").over(over), F.lit(0))).drop("_mix_sum"), "mix-ranges")

    rows = drawn(base)
    inner = Window.partitionBy(*spot).orderBy("_mix_at", id_col, "_mix_tokens").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_mix_inner", F.coalesce(F.sum("_mix_tokens").over(inner), F.lit(0)))
    rows = rows.join(starts, spot).withColumn("_mix_before", F.col("_mix_start") + F.col("_mix_inner"))
    rows = rows.where(F.col("_mix_before") < F.col("_mix_epochs") * F.col("_mix_total"))
    block = F.floor(F.col("_mix_before") / (F.col("_mix_weight") * mix.block_tokens)).cast("long")
    rows = rows.withColumn("block", block).withColumn("tokens", F.col("_mix_tokens"))
    shuffled = Window.partitionBy("block").orderBy(F.xxhash64("_mix_at", F.lit(mix.seed)), "_mix_source", id_col)
    rows = rows.withColumn("position", (F.row_number().over(shuffled) - 1).cast("long"))
    return rows.select(*keep, *made)
