"""Repeated passages across documents: MinHash bands of small paragraphs, exact verification, removal by components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trawlnet.llm.near_dup import linked_classes, text_parts
from trawlnet.llm.packed import marked, unpacked
from trawlnet.llm.shared import as_text, written
from trawlnet.llm.words import MinHash, buffers, mix, shingle_hashes, word_hashes, word_spans

#: Digests of repeated paragraphs that are broadcast, at 24 bytes each; more are shuffled.
BROADCAST_ROWS = 1_000_000


@dataclass(frozen=True)
class Repeats:
    """Paragraphs end at line ends and sentence ends, so that a passage inside a longer line is found; those with
    ``shingle`` words or more count. Similar from ``percent`` Jaccard on. With ``bands`` bands of one hash a pair at 0.8
    collides with probability 1 - 0.2^bands, 0.99994 for 6; five-word shingles hardly meet by chance, so bands of one
    hash are narrow enough. A passage is a run of repeated paragraphs of ``least_words`` words or more."""

    shingle: int = 5
    percent: int = 80
    bands: int = 6
    least_words: int = 30
    seed: int = 77

    def likely(self) -> str:
        """A SQL condition on ``n``, ``mask`` and those of the other set that every similar pair meets: a set lacks at
        least as many shingles of the other one as bits of its mask, so that bounds what both hold."""
        both = (f"{a}n - bit_count({a}mask & ~{b}mask)" for a, b in (("", "other_"), ("other_", "")))
        return " and ".join(f"{100 + self.percent} * ({most}) >= {self.percent} * (n + other_n)" for most in both)


_PLUS, _FLIP = np.uint64(0x8EBC6AF09C88C6E3), np.uint64(0x589965CC75374CC3)
_END = np.zeros(256, dtype=bool)
_END[[ord(c) for c in ".!?"]] = True
_CLOSE = np.zeros(256, dtype=bool)
_CLOSE[[ord(c) for c in "\"')]}"]] = True


def _paragraphs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Word hashes, word places, and for each paragraph its text, first word and end word."""
    begins, ends = word_spans(raw, offsets)
    words = word_hashes(raw, begins, ends)
    if not len(words):
        none = np.zeros(0, np.int64)
        return words, begins, ends, none, none, none
    heads = np.searchsorted(begins, offsets)
    texts = np.repeat(np.arange(len(offsets) - 1), np.diff(heads))
    last = raw[ends - 1]
    before = raw[np.maximum(ends - 2, begins)]
    stop = _END[last] | (_CLOSE[last] & _END[before])
    # the word before each line end and before the end of each text; before the first word there is none, and -1 is a stop
    stop[np.searchsorted(begins, np.flatnonzero(raw == 10)) - 1] = True
    stop[heads[1:] - 1] = True
    to = np.flatnonzero(stop) + 1
    first = np.concatenate([[0], to[:-1]])
    return words, begins, ends, texts[first], first, to


def _sets(words: np.ndarray, first: np.ndarray, to: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The paragraphs of ``k`` words or more, and the distinct shingles of all of them, in any order, with n + 1 places."""
    long = np.flatnonzero(to - first >= k)
    counts = to[long] - first[long] - k + 1
    owner = np.repeat(np.arange(len(long)), counts)
    at = np.repeat(first[long], counts) + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    values = shingle_hashes(words, k)[at]
    # few paragraphs repeat a shingle: only what one sort of both together leaves in doubt is looked at
    both = values + owner.astype(np.uint64) * _PLUS
    ranked = np.sort(both)
    # by their upper bits, which find a few more and cost no second sort
    twice = np.zeros(1 << 20, dtype=bool)
    twice[ranked[1:][ranked[1:] == ranked[:-1]] >> np.uint64(44)] = True
    doubt = np.flatnonzero(twice[both >> np.uint64(44)])
    doubt = doubt[np.lexsort((values[doubt], owner[doubt]))]
    equal = (values[doubt[1:]] == values[doubt[:-1]]) & (owner[doubt[1:]] == owner[doubt[:-1]])
    new = np.ones(len(values), dtype=bool)
    new[doubt[1:][equal]] = False
    return long, values[new], np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=len(long)))])


def _ids(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A digest of 16 bytes for each set, as rows of two numbers."""
    if len(bounds) == 1:
        return np.zeros((0, 2), dtype=np.uint64)
    return np.stack([np.bitwise_xor.reduceat(mix(values + _PLUS), bounds[:-1]), np.add.reduceat(mix(values ^ _FLIP), bounds[:-1])], axis=1)


def _binary(ids: np.ndarray) -> pa.Array:
    offsets = np.arange(len(ids) + 1, dtype=np.int32) * 16
    return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(ids))])


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.view(np.int64)))


def _once(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of each digest, and how often it is found; should first halves be equal by chance, a digest may come twice."""
    order = np.argsort(ids[:, 0])
    new = np.ones(len(ids), dtype=bool)
    new[1:] = (ids[order[1:]] != ids[order[:-1]]).any(axis=1)
    at = np.flatnonzero(new)
    return order[at], np.diff(at, append=len(ids))


def _masks(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64 bits for each set, one of them for each shingle."""
    if len(bounds) == 1:
        return np.zeros(0, dtype=np.int64)
    return np.bitwise_or.reduceat(np.uint64(1) << (values >> np.uint64(58)), bounds[:-1]).view(np.int64)


def _packed(keys: int) -> list[str]:
    """Columns with two band keys of 32 bits each."""
    return [f"keys_{i}" for i in range(-(-keys // 2))]


def _bands(spec: Repeats):
    """Arrow batches of texts to ``high, low, n, mask, keys_0.., found``, equal paragraphs of a batch as one row. All are numbers,
    which Spark adds up in a hash table without sorting: the digest in two halves and the band keys two by two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = MinHash(spec.bands, spec.seed)
        names = _packed(spec.bands)
        for batch in batches:
            for part in text_parts(batch, 0):
                words, _, _, _, first, to = _paragraphs(*buffers(part.column(0)))
                _, values, bounds = _sets(words, first, to, spec.shingle)
                ids = _ids(values, bounds)
                own, found = _once(ids)
                pairs = np.zeros((len(own), 2 * len(names)), dtype=np.uint32)
                if len(ids):
                    pairs[:, : spec.bands] = hashes(values, bounds)[own]
                halves = ids[own].byteswap().view(np.int64)
                made = [halves[:, 0], halves[:, 1], np.diff(bounds)[own], _masks(values, bounds)[own], *pairs.view(np.int64).T, found]
                yield pa.record_batch([pa.array(x) for x in made], names=["high", "low", "n", "mask", *names, "found"])

    return run


def _classes(texts: DataFrame, spec: Repeats) -> DataFrame:
    """``set_id, found, n, mask, bands`` of every distinct set of shingles."""
    names = _packed(spec.bands)
    schema = ", ".join(f"{c} long" for c in ("high", "low", "n", "mask", *names, "found"))
    made = texts.mapInArrow(_bands(spec), schema).groupBy("high", "low")
    made = made.agg(F.sum("found").alias("found"), *[F.min(c).alias(c) for c in ("n", "mask", *names)])
    set_id = F.unhex(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in ("high", "low")])).alias("set_id")
    # the number of the band keeps the keys of different bands apart
    keys = [f"(shiftrightunsigned({names[i // 2]}, {32 * (i % 2)}) & {2**32 - 1}L) | {i << 32}L" for i in range(spec.bands)]
    return made.select(set_id, "found", "n", "mask", F.expr(f"array({', '.join(keys)})").alias("bands"))


def _band_hashes(bands: pa.Array) -> np.ndarray:
    return mix(bands.flatten().to_numpy().view(np.uint64))


def _set_hashes(ids: pa.Array) -> np.ndarray:
    """The first half of each digest, as in ``_ids``."""
    return unpacked(ids, np.uint64)[::2]


def _buckets(classes: DataFrame, spec: Repeats) -> DataFrame:
    """``set_id, n, mask, bands, band, key``: a row for each class and band that it shares with another class, and few others.

    Most keys of bands occur once, so they are counted alone, and the classes need no shuffle.
    """
    marks = marked(classes.select("bands"), _band_hashes, classes.count() * spec.bands, least=2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = batch.column(3)
            at = np.flatnonzero(marks.value.have(_band_hashes(bands)))
            rows = batch.take(pa.array(at // spec.bands))
            made = [*rows.columns, pa.array((at % spec.bands).astype(np.int32)), bands.flatten().take(pa.array(at))]
            yield pa.record_batch(made, names=["set_id", "n", "mask", "bands", "band", "key"])

    schema = "set_id binary, n long, mask long, bands array<long>, band int, key long"
    rows = classes.select("set_id", "n", "mask", "bands").mapInArrow(run, schema)
    rows = written(rows, "buckets")
    marks.unpersist()
    return rows


def _shingles(spec: Repeats, wanted: Broadcast):
    """Arrow batches of texts to ``set_id, shingles`` of the paragraphs whose set is ``wanted``, and few others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch, 0):
                words, _, _, _, first, to = _paragraphs(*buffers(part.column(0)))
                _, values, bounds = _sets(words, first, to, spec.shingle)
                ids = _ids(values, bounds)
                own = wanted.value.have(ids[:, 0])
                sizes = np.diff(bounds)
                bounds = np.concatenate([[0], np.cumsum(sizes[own])])
                yield pa.record_batch([_binary(ids[own]), _lists(values[np.repeat(own, sizes)], bounds)], names=["set_id", "shingles"])

    return run


def _places(spec: Repeats, wanted: Broadcast):
    """Arrow batches of ``doc_id, text_hash, text`` to a row for each paragraph whose set is ``wanted``, and few others:
    ``at`` counts all that count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch, 2):
                raw, offsets = buffers(part.column(2))
                words, begins, ends, texts, first, to = _paragraphs(raw, offsets)
                long, values, bounds = _sets(words, first, to, spec.shingle)
                ids, own = _ids(values, bounds), texts[long]
                at = np.arange(len(own)) - np.searchsorted(own, own)
                keep = wanted.value.have(ids[:, 0])
                long, own, at = long[keep], own[keep], at[keep]
                chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                base = chars[offsets[own]]
                made = [
                    part.column(0).take(pa.array(own)),
                    part.column(1).take(pa.array(own)),
                    pa.array(at),
                    pa.array(chars[begins[first[long]]] - base),
                    pa.array(chars[ends[to[long] - 1]] - base),
                    pa.array(to[long] - first[long]),
                    _binary(ids[keep]),
                ]
                yield pa.record_batch(made, names=["doc_id", "text_hash", "at", "start", "end", "words", "set_id"])

    return run


def repeated_passages(
    docs: DataFrame, spec: Repeats = Repeats(), id_col: str = "doc_id", text_col: str = "text", with_hash: bool = False
) -> DataFrame:
    """``doc_id, start, end, n_words, component, removed``: every passage that is found again, in this or another text.

    Paragraphs with similar shingle sets are one component. Neighbouring paragraphs are in one passage if both are
    repeated and the pair of their components is found at least twice; shorter paragraphs between them are skipped.
    In each component the first paragraph, by id and place, stays; ``removed`` tells the pieces of passages that go
    from those that stay; a piece ends where the two meet. ``start`` and ``end`` count characters, the end exclusive; ``component`` is the lowest of
    the piece. Common single sentences are left alone, for they make no run of ``least_words`` words.

    Equal paragraphs are one class with a count from the start; only classes that are repeated or share a band take
    part in joins. Null and empty texts have no paragraphs; null ids come last; rows that repeat id and text are
    given once, though their paragraphs count as repeated; other columns are ignored; an empty table gives no rows.
    """
    text = as_text(F.col(text_col)).alias("text")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(as_text(F.col(text_col))).alias("text_hash"), text)
    classes = written(_classes(texts.select("text"), spec), "paragraphs")

    members = _buckets(classes, spec)
    wanted = marked(members.select("set_id"), _set_hashes, members.count())
    sets = texts.select("text").mapInArrow(_shingles(spec, wanted), "set_id binary, shingles array<long>")
    sets = written(sets.groupBy("set_id").agg(F.any_value("shingles").alias("shingles")), "sets")
    wanted.unpersist()
    named = linked_classes(members, sets, spec.percent, spec.likely(), ("mask",), bands=spec.bands)

    named = named.withColumnRenamed("node", "set_id")
    named = F.broadcast(named) if named.count() <= BROADCAST_ROWS else named
    repeated = classes.select("set_id", "found").join(named, "set_id", "left")
    repeated = repeated.where("found > 1 or component is not null").select("set_id", F.coalesce("component", "set_id").alias("component"))
    repeated = written(repeated, "repeated")
    among = marked(repeated.select("set_id"), _set_hashes, many := repeated.count())
    if many <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash long, at long, start long, end long, words long, set_id binary"
    found = texts.mapInArrow(_places(spec, among), schema).join(repeated, "set_id").drop("set_id")
    found = found.withColumn("doc", F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    one = Window.partitionBy("doc_id", "text_hash").orderBy("at")
    found = found.withColumn("again", F.lag("at").over(one) == F.col("at")).where("again is null or not again").drop("again")
    # the pair with the paragraph before, where that one is repeated too
    pair = F.when(F.lag("at").over(one) == F.col("at") - 1, F.xxhash64(F.lag("component").over(one), "component"))
    found = written(found.withColumn("pair", pair), "repeated-places")
    among.unpersist()
    pairs = found.where("pair is not null").groupBy("pair").count().where("count > 1").select("pair", F.lit(True).alias("joined"))
    firsts = found.groupBy("component").agg(F.min(F.struct("doc", "at")).alias("first"))
    # rows without a pair, a fifth of them or more, would meet in one task: each is joined by its own place instead
    found = found.withColumn("by", F.coalesce("pair", F.xxhash64("doc_id", "text_hash", "at")))
    found = found.join(pairs.withColumnRenamed("pair", "by"), "by", "left").join(firsts, "component")
    removed = (F.col("first.doc") != F.col("doc")) | (F.col("first.at") != F.col("at"))
    found = found.withColumn("removed", removed).withColumn("break", F.when(F.col("joined") & F.col("pair").isNotNull(), 0).otherwise(1))
    found = found.withColumn("run", F.sum("break").over(one)).withColumn("run_words", F.sum("words").over(Window.partitionBy("doc_id", "text_hash", "run")))
    # a run turns where paragraphs that stay and that go meet, so no removed piece covers one that stays
    same = (F.lag("run").over(one) == F.col("run")) & (F.lag("removed").over(one) == F.col("removed"))
    found = found.withColumn("piece", F.sum(F.when(same, 0).otherwise(1)).over(one))
    pieces = found.where(F.col("run_words") >= spec.least_words).groupBy("doc_id", "text_hash", "piece", "removed")
    pieces = pieces.agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("n_words"), F.hex(F.min("component")).alias("component")
    )
    return pieces.select("doc_id", *["text_hash"] * with_hash, "start", "end", "n_words", "component", "removed")
