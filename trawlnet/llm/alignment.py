"""Two tokenizers over the same texts: where their tokens end together, which tokens overlap, and how often corpus-wide.

Everything between the encoders and Spark stays in Arrow: lists are flattened with their parent indices, byte ends are
segmented running sums, a hash join on (text, end) finds where both end, and ``group_by`` counts linked ids before
Spark adds the counts up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawlnet.llm.segments import ByteTokens, by_bytes, contents, large, tokens_of
from trawlnet.llm.shared import spread_join, written
from trawlnet.llm.token_counts import Tokenizer

#: Bytes of text aligned at once: a few hundred bytes of tables for each token.
SLICE_BYTES = 2 << 20
#: Linked id pairs sent to all tasks, 17 bytes each; beyond it they are joined.
BROADCAST_PAIRS = 2_000_000


def _text(value: str) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


@dataclass(frozen=True)
class Alignment:
    """``groups`` is what the column ``groups`` holds: ``text`` for ``a1,a2|b1;a3|b2,b3``, or its ``sha256`` in hex."""

    groups: str = "text"


def segmented_ends(lengths: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element of lists with ``counts`` elements: its list, and the running sum of ``lengths`` in that list."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int64())
    lists = pa.LargeListArray.from_arrays(offsets, pa.array(lengths, pa.int64()))
    rows, sums = pc.list_parent_indices(lists), pc.cumulative_sum(lists.flatten())
    before = np.concatenate([[0], sums.to_numpy()])[offsets.to_numpy()[:-1]]
    return rows.to_numpy(), pc.subtract(sums, pa.array(before).take(rows)).to_numpy()


def linked(a_ids: np.ndarray, a_rows: np.ndarray, a_ends: np.ndarray, b_ids: np.ndarray, b_rows: np.ndarray, b_ends: np.ndarray) -> pa.Table:
    """``row, a, b, a_ends, b_ends`` of every overlapping pair of tokens, in order; the last two tell which of them ends
    where the overlap does.

    Two tokens overlap in one stretch, and it ends where either ends: a full outer join of both sides on (row, end) has
    a row for each overlap, and the token that goes on is the next one of its side.
    """
    a = pa.table({"row": a_rows, "end": a_ends, "a": pa.array(a_ids, pa.int32())})
    b = pa.table({"row": b_rows, "end": b_ends, "b": pa.array(b_ids, pa.int32())})
    ends = a.join(b, keys=["row", "end"], join_type="full outer", use_threads=False).combine_chunks()
    order = np.lexsort((ends["end"].to_numpy(), ends["row"].to_numpy()))
    ends = ends.take(pa.array(order)).combine_chunks()
    sides = {c: ends[c].combine_chunks() for c in ("a", "b")}
    filled = {c: pc.fill_null_backward(v) for c, v in sides.items()}
    return pa.table({"row": ends["row"], **filled, **{f"{c}_ends": pc.is_valid(v) for c, v in sides.items()}})


def group_texts(links: pa.Table, n: int) -> tuple[list[bytes], np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` of each of ``n`` rows, and its number of groups."""
    rows = links["row"].to_numpy()
    a_end, b_end = links["a_ends"].to_numpy(), links["b_ends"].to_numpy()
    common = a_end & b_end
    group = np.cumsum(common) - common
    a_group, b_group = group[a_end], group[b_end]
    every = np.arange(int(common.sum()))
    a_through, b_through = (np.searchsorted(g, every, side="right") for g in (a_group, b_group))
    # in a group its A ids come first, then its B ids
    a_at = np.arange(len(a_group)) + np.concatenate([[0], b_through])[a_group]
    b_at = np.arange(len(b_group)) + a_through[b_group]
    ids = np.empty(len(a_at) + len(b_at), np.int32)
    ids[a_at], ids[b_at] = links["a"].to_numpy()[a_end], links["b"].to_numpy()[b_end]
    sign = np.zeros(len(ids), np.int8)
    sign[a_at[a_through - 1]] = 1
    sign[b_at[b_through - 1]] = 2
    n_groups = np.bincount(rows[common], minlength=n)
    held = np.bincount(rows, weights=a_end, minlength=n).astype(np.int64) + np.bincount(rows, weights=b_end, minlength=n).astype(np.int64)
    places = np.concatenate([[0], np.cumsum(held)])
    sign[places[1:][held > 0] - 1] = 3
    signs = pa.array([",", "|", ";", ""], pa.large_string()).take(pa.array(sign))
    joined = pc.binary_join_element_wise(pa.array(ids).cast(pa.large_string()), signs, _text(""))
    raw, ends = contents(joined)
    return [raw[x:y].tobytes() for x, y in zip(ends[places[:-1]].tolist(), ends[places[1:]].tolist(), strict=True)], n_groups


def _same(side: ByteTokens, ids: np.ndarray, counts: np.ndarray, raw: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each id, and for each text whether its ids spell it."""
    joined, lengths = side.joined(ids)
    if len(joined) == len(raw) and np.array_equal(joined, raw):
        starts = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
        if np.array_equal(starts, places):
            return lengths, np.ones(len(counts), dtype=bool)
    ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
    texts = zip(ends[:-1].tolist(), ends[1:].tolist(), places[:-1].tolist(), places[1:].tolist(), strict=True)
    return lengths, np.array([np.array_equal(joined[a:b], raw[c:d]) for a, b, c, d in texts], dtype=bool)


_DOC = "n_a long, n_b long, n_links long, n_groups long, groups string, a array<int>, b array<int>, times array<int>"
_PAIR = "pair_a int, pair_b int, pair_n long"


def _aligner(a: Tokenizer, b: Tokenizer, spec: Alignment):
    """Arrow batches of ``doc_id, text`` to a row for each text, with its distinct linked ids and how often it links
    them, and rows with the counts of linked ids of a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: list[ByteTokens] = []
        for batch in batches:
            sides = sides or [tokens_of(a), tokens_of(b)]
            for part in by_bytes(batch, 1, SLICE_BYTES):
                yield from _aligned(sides, part, spec)

    return run


def _aligned(sides: list[ByteTokens], part: pa.RecordBatch, spec: Alignment) -> Iterator[pa.RecordBatch]:
    texts = large(part.column(1))
    asked = np.flatnonzero(pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    raw, places = contents(pc.binary_join_element_wise(_text(" "), texts.take(pa.array(asked)), _text("")))
    encoded, good = [], np.ones(len(asked), dtype=bool)
    for side in sides:
        ids, counts = side(raw, places)
        lengths, same = _same(side, ids, counts, raw, places)
        encoded.append((ids, counts, lengths))
        good &= same
    tokens, n_tokens = [], []
    for ids, counts, lengths in encoded:
        own = np.repeat(good, counts)
        counts = np.where(good, counts, 0)
        rows, ends = segmented_ends(lengths[own], counts)
        tokens += [ids[own], rows, ends]
        n_tokens.append(counts)
    n = len(asked)
    links = linked(*tokens)
    groups, n_groups = group_texts(links, n)
    # distinct linked ids of each text, then of the slice
    counted = links.group_by(["row", "a", "b"], use_threads=False).aggregate([([], "count_all")]).combine_chunks()
    counted = counted.take(pa.array(np.argsort(counted["row"].to_numpy(), kind="stable")))
    pairs = counted.group_by(["a", "b"], use_threads=False).aggregate([("count_all", "sum")])
    per_row = np.bincount(counted["row"].to_numpy(), minlength=n)

    every, back = part.num_rows, np.full(part.num_rows, -1)
    back[asked] = np.arange(n)
    full = back >= 0

    def spread(values: np.ndarray) -> pa.Array:
        out = np.zeros(every, np.int64)
        out[full] = values
        return pa.array(out)

    sizes = np.zeros(every, np.int64)
    sizes[full] = per_row
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    shown = [""] * every
    for i, g in zip(asked.tolist(), groups, strict=True):
        shown[i] = g.decode() if spec.groups == "text" or not g else hashlib.sha256(g).hexdigest()
    n_links = np.bincount(links["row"].to_numpy(), minlength=n)
    lists = [pa.ListArray.from_arrays(offsets, counted[c].combine_chunks().cast(pa.int32())) for c in ("a", "b", "count_all")]
    made = [part.column(0), *(spread(x) for x in (*n_tokens, n_links, n_groups)), pa.array(shown, pa.string()), *lists]
    names = ["doc_id", "n_a", "n_b", "n_links", "n_groups", "groups", "a", "b", "times"]
    schema = pa.schema([*zip(names, (x.type for x in made), strict=True), ("pair_a", pa.int32()), ("pair_b", pa.int32()), ("pair_n", pa.int64())])
    yield pa.record_batch([*made, *(pa.nulls(every, t) for t in schema.types[-3:])], schema=schema)
    found = [pairs[c].combine_chunks().cast(t) for c, t in zip(("a", "b", "count_all_sum"), schema.types[-3:], strict=True)]
    yield pa.record_batch([*(pa.nulls(pairs.num_rows, t) for t in schema.types[:-3]), *found], schema=schema)


def _pair(a: str, b: str):
    return F.shiftleft(F.col(a).cast("long"), 32).bitwiseOR(F.col(b).cast("long"))


def linked_counts(made: DataFrame) -> DataFrame:
    """``pair, n, best``: how many links hold two ids, and whether no other A id has more with that B id."""
    counts = made.where("pair_n is not null").groupBy("pair_a", "pair_b").agg(F.sum("pair_n").alias("n"))
    counts = written(counts, "linked-ids")
    most = counts.groupBy("pair_b").agg(F.max("n").alias("most"))
    return counts.join(most, "pair_b").select(_pair("pair_a", "pair_b").alias("pair"), "n", (F.col("n") == F.col("most")).alias("best"))


def _scorer(shared):
    """Arrow batches of texts with their linked ids to the same without those, with ``n_best`` and ``count_sum``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = shared.value
        for batch in batches:
            a, b, times = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("a", "b", "times"))
            rows = pc.list_parent_indices(batch.column("a")).to_numpy()
            at = np.searchsorted(pairs, (a << 32) | b)
            sums = []
            for values in (np.where(best[at], times, 0) if len(at) else times, counts[at] * times if len(at) else times):
                out = np.zeros(batch.num_rows, np.int64)
                np.add.at(out, rows, values)
                sums.append(pa.array(out))
            kept = [c for c in batch.schema.names if c not in ("a", "b", "times")]
            yield pa.record_batch([*(batch.column(c) for c in kept), *sums], names=[*kept, "n_best", "count_sum"])

    return run


def align(
    docs: DataFrame,
    a: Tokenizer,
    b: Tokenizer,
    spec: Alignment = Alignment(),
    id_col: str = "doc_id",
    text_col: str = "text",
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` of every row of ``docs``.

    Both tokenizers spell a space and the text. Places where tokens of both end cut them into groups; two tokens are
    linked where their bytes overlap. The count of two ids is how many links of all texts hold them: ``count_sum`` adds
    it up over a text's links, ``n_best`` counts the links whose count no other A id exceeds with that B id.

    Null and empty texts, and those that either tokenizer does not spell back byte by byte, have no tokens: zeros, and
    an empty ``groups``. Rows that repeat an id or a text are texts of their own; null ids are kept; other columns are
    ignored; an empty table gives no rows. Counts of up to ``broadcast_pairs`` pairs are sent to the texts; more of them
    are joined, the hottest pairs dealt to several tasks.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    made = texts.mapInArrow(_aligner(a, b, spec), f"doc_id {kind}, {_DOC}, {_PAIR}")
    made = written(made.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = written(linked_counts(made), "counts")
    rows = made.where("pair_n is null").drop("pair_a", "pair_b", "pair_n")
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    if counts.count() <= broadcast_pairs:
        held = counts.toArrow().sort_by("pair")
        shared = docs.sparkSession.sparkContext.broadcast(tuple(held[c].to_numpy() for c in ("pair", "n", "best")))
        plain = rows.drop("row")
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema if f.name not in ("a", "b", "times"))
        return plain.mapInArrow(_scorer(shared), f"{schema}, n_best long, count_sum long").select(*columns)
    pairs = rows.select("row", F.explode(F.arrays_zip("a", "b", "times")).alias("link"))
    pairs = pairs.select("row", _pair("link.a", "link.b").alias("pair"), F.col("link.times").cast("long").alias("times"))
    joined = spread_join(pairs, counts, "pair", "inner")
    sums = joined.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum")
    )
    joined = rows.join(sums, "row", "left").withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_best", "count_sum")})
    return joined.select(*columns)
