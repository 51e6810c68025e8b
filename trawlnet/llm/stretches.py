"""Exact repeated stretches of words across documents: winnowed candidates, then every run of ``words`` words counted."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trawlnet.llm.near_dup import text_parts
from trawlnet.llm.packed import dealt, marked, met, parts_of
from trawlnet.llm.paragraphs import Repeats, repeated_passages
from trawlnet.llm.shared import as_text, passing_tables, spent, written
from trawlnet.llm.words import buffers, mix, shingle_hashes, word_hashes, word_spans

#: Words of a stretch; candidates share the lowest hash among its runs of ``GRAM`` words.
WORDS, GRAM = 50, 25
_ZERO = np.uint64(0)


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbours."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out, have = pick(out[:-step], out[step:]), have + step
    return out


def _windows(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Word hashes, each text's first word, the lowest hash of every ``WORDS`` words, and which of those are in one text."""
    raw, offsets = buffers(column)
    begins, ends = word_spans(raw, offsets)
    words, bounds = word_hashes(raw, begins, ends), np.searchsorted(begins, offsets)
    if len(words) < WORDS:
        none = np.zeros(0, np.uint64)
        return words, bounds, none, none, np.zeros(0, bool)
    grams = shingle_hashes(words, GRAM)
    lows = _sliding(grams, WORDS - GRAM + 1, np.minimum)
    texts = np.searchsorted(bounds, np.arange(len(lows)), side="right") - 1
    return words, bounds, grams, lows, np.arange(len(lows)) + WORDS <= bounds[texts + 1]


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches of ``doc_id, text_hash, text`` to each text's fingerprints, as often as it has them."""
    for batch in batches:
        for part in text_parts(batch, 2):
            _, bounds, grams, lows, inside = _windows(part.column(2))
            # a run of GRAM words is a fingerprint where it is the lowest of any stretch around it
            pad = np.zeros(WORDS - GRAM, np.uint64)
            best = _sliding(np.concatenate([pad, np.where(inside, lows, _ZERO), pad]), WORDS - GRAM + 1, np.maximum) if len(lows) else grams
            at = np.flatnonzero((grams == best) & (best > _ZERO))
            texts, prints = np.searchsorted(bounds, at, side="right") - 1, grams[at].view(np.int64)
            bounds = np.searchsorted(texts, np.arange(part.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(prints, pa.int64()))
            yield pa.record_batch([part.column(0), part.column(1), lists], names=["doc_id", "text_hash", "lows"])


def _list_hashes(column: pa.Array) -> np.ndarray:
    return mix(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))


def _shared(marks: Broadcast):
    """Arrow batches of ``doc_id, text_hash, lows`` to the texts with a marked fingerprint, and their marked ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.flatnonzero(marks.value.have(_list_hashes(batch.column(2))))
            own, lows = _lists(batch.column(2))
            rows, sizes = np.unique(own[at], return_counts=True)
            bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), lows.take(pa.array(at)))
            rows = pa.array(rows, pa.int64())
            yield pa.record_batch([batch.column(0).take(rows), batch.column(1).take(rows), lists], names=["doc_id", "text_hash", "lows"])

    return run


def _among(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which of ``values`` are in ``wanted``, which ascends."""
    if not len(wanted):
        return np.zeros(len(values), dtype=bool)
    return wanted[np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)] == values


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches of ``row, text, lows`` to every stretch with a fingerprint among ``lows``. ``spot`` is twice the place
    of its first word, and one more where the text had the stretch before."""
    for batch in batches:
        for part in text_parts(batch, 1):
            words, bounds, _, lows, inside = _windows(part.column(1))
            full = shingle_hashes(words, WORDS)
            # a fingerprint that any text wants is in several, and so every text that has it wants it
            wanted = np.unique(part.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            # neighbouring stretches mostly have the same lowest hash
            heads = np.flatnonzero(np.append(True, lows[1:] != lows[:-1])[: len(lows)])
            known = _among(lows[heads], wanted)
            at = np.flatnonzero(inside & np.repeat(known, np.diff(heads, append=len(lows))))
            texts, hashes = np.searchsorted(bounds, at, side="right") - 1, full[at]
            order = np.lexsort((hashes, texts))
            again = np.zeros(len(at), np.int64)
            again[order[1:]] = (texts[order[1:]] == texts[order[:-1]]) & (hashes[order[1:]] == hashes[order[:-1]])
            spots = 2 * (at - bounds[texts]) + again
            made = [part.column(0).take(pa.array(texts, pa.int64())), pa.array(spots, pa.int64()), pa.array(hashes.view(np.int64), pa.int64())]
            yield pa.record_batch(made, names=["row", "spot", "gram"])


def _dealt_grams(parts: int):
    """Arrow batches of ``row, text, lows`` to packed stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = ([batch.column(c).to_numpy() for c in ("gram", "row", "spot")] for batch in _grams(batches))
        blocks = ((mix(gram.view(np.uint64)), (gram, row, spot.astype(np.int32))) for gram, row, spot in made)
        return dealt(blocks, parts, ["gram", "row", "spot"])

    return run


def _hits(parts: int):
    """Packed stretches of a part to packed hits of those that are repeated; see ``_pieces``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, rows, spots = met(batches, {"gram": np.int64, "row": np.int64, "spot": np.int32})
        order = np.argsort(grams)
        grams, rows, spots = grams[order], rows[order], spots[order]
        heads = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])[: len(grams)])
        sizes = np.diff(heads, append=len(grams))
        lowest = np.minimum.reduceat(rows, heads) if len(heads) else rows
        first = (rows == np.repeat(lowest, sizes)) & (spots % 2 == 0)
        again = np.repeat(sizes > 1, sizes)
        hits = (spots - spots % 2 + first)[again].astype(np.int32)
        rows = rows[again]
        return dealt(iter([(mix(rows.view(np.uint64)), (rows, hits))]) if len(rows) else iter([]), parts, ["row", "hit"])

    return run


def _hits_of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed hits of a part to ``row, hits``."""
    rows, hits = met(batches, {"row": np.int64, "hit": np.int32})
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    heads = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])[: len(rows)])
    bounds = np.append(heads, len(rows)).astype(np.int32)
    yield pa.record_batch([pa.array(rows[heads]), pa.ListArray.from_arrays(pa.array(bounds), pa.array(hits[order]))], names=["row", "hits"])


def _cover(begins: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` words lie between any ``begins`` and its ``ends``."""
    steps = np.bincount(begins, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


def _lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Owner of each value of a list column, a null being empty, and the values."""
    return column.value_parent_indices().to_numpy(), column.flatten()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches of ``doc_id, text, hits, taken`` to the parts of repeated stretches outside of the taken pieces. A hit
    is twice the place of a repeated stretch, and one more where it is the first of its kind."""
    names = ["doc_id", "start", "end", "n_words", "component", "removed"]
    for batch in batches:
        for part in text_parts(batch, 1):
            raw, offsets = buffers(part.column(1))
            begins, ends = word_spans(raw, offsets)
            chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            starts, stops, base, bounds = chars[begins], chars[ends], chars[offsets], np.searchsorted(begins, offsets)
            n = len(begins)
            text, hits = _lists(part.column(2))
            hits = hits.to_numpy(zero_copy_only=False)
            at, first = bounds[text] + (hits >> 1), (hits & 1) == 1
            stay = _cover(at[first], at[first] + WORDS, n)
            every = _cover(at, at + WORDS, n)
            text, taken = _lists(part.column(3))
            low, high = (np.searchsorted(starts, taken.field(k).to_numpy(zero_copy_only=False) + base[text]) for k in (0, 1))
            free = every & ~_cover(low, high, n)
            state = np.where(free, np.where(stay, 1, 2), 0)
            # a stretch is named by its lowest run, as its copies are
            heads = np.zeros(n + 1, dtype=bool)
            heads[bounds] = True
            whole = np.cumsum(every & (heads[:n] | ~np.concatenate([[False], every[:-1]])))
            name = np.full(int(whole[-1]) + 1, np.iinfo(np.int64).max)
            np.minimum.at(name, whole[at], shingle_hashes(word_hashes(raw, begins, ends), WORDS)[at].view(np.int64))
            heads[1:n] |= (np.diff(state) != 0) | (np.diff(whole) != 0)
            heads[0] = True
            a = np.flatnonzero(heads[:n])
            b = np.append(a[1:], n)
            a, b = a[state[a] > 0], b[state[a] > 0]
            own = np.searchsorted(bounds, a, side="right") - 1
            made = [
                part.column(0).take(pa.array(own, pa.int64())),
                pa.array(starts[a] - base[own], pa.int64()),
                pa.array(stops[b - 1] - base[own], pa.int64()),
                pa.array(b - a, pa.int64()),
                pa.array([f"{x:016X}" for x in name[whole[a]].view(np.uint64).tolist()], pa.string()),
                pa.array(state[a] == 2),
            ]
            yield pa.record_batch(made, names=names)


def _of_doc(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Joined by text, a null id being equal to a null id."""
    right = right.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    return left.join(right, (F.col("text_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id")), how).drop("_id", "_hash")


def all_passages(docs: DataFrame, spec: Repeats = Repeats(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``repeated_passages``, and rows for what they leave of every exact repeat of ``WORDS`` words or more.

    A stretch is any run of words that stands again word for word (A-Z lower-cased), whatever its sentences and lines;
    it reaches to exact word edges. Its rows are the parts that no passage covers, so rows never overlap. In each run
    of ``WORDS`` words the first occurrence, by id and place, stays; words of a later one go unless they are also in a
    first one or in a passage that stays. ``component`` of such a row is the lowest hash of its stretch.
    """
    with passing_tables(docs.sparkSession) as tables:
        passages = written(repeated_passages(docs, spec, id_col, text_col, with_hash=True), "passages")
        spent(docs.sparkSession, tables[:-1])
        del tables[:]
        more = written(_stretches(docs, passages, id_col, text_col), "stretch-pieces")
        spent(docs.sparkSession, tables[:-1])
    return passages.drop("text_hash").unionByName(more)


def _stretches(docs: DataFrame, passages: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``all_passages`` that are not in ``passages``."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(as_text(F.col(text_col))).alias("text_hash"), as_text(F.col(text_col)).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash long, lows array<long>"
    prints = written(named.mapInArrow(_prints, schema), "prints")
    many = prints.agg(F.sum(F.size("lows"))).first()[0] or 0
    marks = marked(prints.select("lows"), _list_hashes, many, least=2)
    # a fingerprint that is marked by chance costs its stretches, which are not repeated
    needed = prints.mapInArrow(_shared(marks), schema).dropDuplicates(["doc_id", "text_hash"])
    # rows ascend as texts do, by id and text, so the lowest row of a stretch has it first
    needed = needed.orderBy(F.col("doc_id").isNull(), "doc_id", "text_hash").withColumn("row", F.monotonically_increasing_id())
    needed = written(needed, "needed-texts")
    marks.unpersist()
    texts = written(_of_doc(named, needed, "inner").select("row", "doc_id", "text_hash", "text", "lows"), "stretch-texts")
    # a fingerprint is the lowest hash of 26 stretches at most, of 6 on the given texts
    parts = parts_of((texts.agg(F.sum(F.size("lows"))).first()[0] or 0) * 8)
    grams = texts.select("row", "text", "lows").mapInArrow(_dealt_grams(parts), "part int, gram binary, row binary, spot binary")
    hits = grams.repartitionById(parts, "part").mapInArrow(_hits(parts), "part int, row binary, hit binary")
    hits = written(hits.repartitionById(parts, "part").mapInArrow(_hits_of_rows, "row long, hits array<int>"), "stretch-hits")
    taken = passages.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "end")).alias("taken"))
    known = _of_doc(needed.drop("lows").join(hits, "row"), taken, "left").select("row", "hits", "taken")
    # of rows that repeat id and text one is looked at; texts are dealt out once, by row
    single = texts.withColumn("again", F.lag(F.lit(1)).over(Window.partitionBy("row").orderBy("row"))).where("again is null")
    joined = single.join(known, "row").select("doc_id", "text", "hits", "taken")
    return joined.mapInArrow(_pieces, f"doc_id {kind}, start long, end long, n_words long, component string, removed boolean")
