"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming search, exact verification."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawlnet.llm.near_dup import text_parts
from trawlnet.llm.shared import as_text
from trawlnet.llm.words import KEEP, MARKS, buffers, mix, shingle_hashes, word_hashes, word_spans

#: Bytes of benchmark text in one block; a larger benchmark is searched in several blocks, each sent to all tasks.
BLOCK_BYTES = 16 << 20
#: Windows whose fingerprints are made at once.
WINDOWS = 1 << 14
_SECOND = np.uint64(0xA24BAED4963EE407)


@dataclass(frozen=True)
class Contamination:
    """Shingles of ``shingle`` words; a window matches from ``percent`` weighted Jaccard similarity on. Fingerprints
    have 128 bits; the expected distance at 80 percent is 19 bits with a deviation of 4, so ``radius`` 36 misses about
    one such window in 50,000, and every fingerprint within it is found."""

    shingle: int = 5
    percent: int = 80
    radius: int = 36


BITS, BLOCKS = 128, 16
_DISTANCE = np.array([[bin(a ^ b).count("1") for b in range(256)] for a in range(256)], dtype=np.uint8)


def _close_values(most: int) -> np.ndarray:
    """For each byte value, the values at most ``most`` bits away."""
    flips = np.array([v for v in range(256) if bin(v).count("1") <= most])
    return np.arange(256)[:, None] ^ flips[None, :]


def _fingerprints(shingles: np.ndarray, weights: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """SimHash of runs of weighted shingles, as rows of 16 bytes: the sign of each bit's weighted votes."""
    votes = np.stack([mix(shingles), mix(shingles ^ _SECOND)], axis=1).view(np.uint8).reshape(len(shingles), BLOCKS)
    signed = (np.unpackbits(votes, axis=1).astype(np.int64) * 2 - 1) * weights[:, None]
    sums = np.zeros((len(shingles) + 1, BITS), dtype=np.int64)
    np.cumsum(signed, axis=0, out=sums[1:])
    return np.packbits(sums[begins + sizes] - sums[begins] > 0, axis=1)


def run_sums(values: np.ndarray, k: int) -> np.ndarray:
    """Sums of every run of ``k`` values."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[k:] - sums[:-k]


def bag(shingles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles with their counts and weights."""
    keys, first, counts = np.unique(shingles, return_index=True, return_counts=True)
    return keys, counts, weights[first]


class Index:
    """Benchmark items ready to be searched: shingle bags, fingerprints, and for each item size a table of its Hamming
    blocks. Built in each worker from the items' words, which are all that travels.

    A shingle weighs as many bytes as its words have, so its weight does not depend on the other items."""

    def __init__(self, spec: Contamination, ids: list[list], items: list[np.ndarray], lengths: list[np.ndarray]):
        """``items`` are the word hashes of each item, ``lengths`` the bytes of each word, ``ids`` the ids it has."""
        self.spec, self.ids = spec, ids
        self.k = np.array([min(spec.shingle, len(w)) for w in items])
        self.n = np.array([len(w) for w in items])
        sets = [shingle_hashes(w, k) for w, k in zip(items, self.k.tolist(), strict=True)]
        weights = [run_sums(n, k) for n, k in zip(lengths, self.k.tolist(), strict=True)]
        self.bags = [bag(s, w) for s, w in zip(sets, weights, strict=True)]
        self.weight = np.array([int(w.sum()) for w in weights])
        self.prints = np.concatenate([_fingerprints(s, w, np.zeros(1, int), np.array([len(s)])) for s, w in zip(sets, weights, strict=True)])
        # for each shingle length: its shingles, behind a bit table, and the item sizes that contain each
        self.sizes = {k: np.unique(self.n[self.k == k]) for k in sorted(set(self.k.tolist()))}
        self.table, self.bits = {}, {}
        for k in self.sizes:
            own = np.flatnonzero(self.k == k)
            keys = np.concatenate([self.bags[i][0] for i in own])
            pairs = np.unique(np.stack([keys, np.repeat(self.n[own], [len(self.bags[i][0]) for i in own]).astype(np.uint64)], axis=1), axis=0)
            keys, starts = np.unique(pairs[:, 0], return_index=True)
            self.table[k] = (keys, np.append(starts, len(pairs)), pairs[:, 1].astype(np.int64))
            self.bits[k] = np.bincount((keys & np.uint64(0xFFFFF)).astype(np.int64), minlength=1 << 20) > 0
        # distance within the radius leaves some block within radius // BLOCKS
        self.close = _close_values(spec.radius // BLOCKS) + 256 * np.arange(BLOCKS)[:, None, None]
        self.blocks = {int(n): self._block_table(np.flatnonzero(self.n == n)) for n in np.unique(self.n)}

    def _block_table(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items by block and byte value: where those of each begin, and their numbers."""
        slot = (self.prints[own] + 256 * np.arange(BLOCKS)).ravel()
        order = np.argsort(slot, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(slot, minlength=256 * BLOCKS))]).astype(np.int32)
        return starts, np.repeat(own, BLOCKS)[order].astype(np.int32)

    def near(self, prints: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of ``prints``, item of ``n`` words) within the radius, found by their blocks."""
        starts, items = self.blocks[n]
        slots = self.close[np.arange(BLOCKS)[None, :], prints].reshape(len(prints), -1)
        row, column = np.nonzero(starts[slots + 1] > starts[slots])
        slot = slots[row, column]
        spread = starts[slot + 1] - starts[slot]
        pairs = np.repeat(row, spread) * len(self.n) + items[np.repeat(starts[slot], spread) + _counting(spread)]
        row, item = np.divmod(np.unique(pairs), len(self.n))
        distance = _DISTANCE[prints[row], self.prints[item]].sum(axis=1, dtype=np.int64)
        close = distance <= self.spec.radius
        return row[close], item[close]

    def members(self, shingles: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of shingles that some item has, and their rows in the table."""
        keys = self.table[k][0]
        maybe = np.flatnonzero(self.bits[k][(shingles & np.uint64(0xFFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(keys, shingles[maybe]), len(keys) - 1)
        true = keys[at] == shingles[maybe]
        return maybe[true], at[true]

    def shared(self, item: int, shingles: np.ndarray, hits: np.ndarray, begins: np.ndarray, runs: int) -> np.ndarray:
        """The weighted intersection of an item and each window of ``runs`` shingles from ``begins``.

        The c-th copy of a shingle that the item has c times counts while the window holds it and not the c copies
        before it are inside too: an occurrence counts for a range of begins, and sums over ranges are two lookups.
        """
        keys, counts, weights = self.bags[item]
        key = np.minimum(np.searchsorted(keys, shingles[hits]), len(keys) - 1)
        own = keys[key] == shingles[hits]
        at, key = hits[own], key[own]
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        before = np.arange(len(key)) - counts[key]
        copy = (before >= 0) & (key[np.maximum(before, 0)] == key)
        first = np.maximum(at - runs + 1, np.where(copy, at[np.maximum(before, 0)] + 1, 0))
        counts_at_all = first <= at
        first, last, weight = first[counts_at_all], at[counts_at_all], weights[key[counts_at_all]]

        def up_to(places: np.ndarray, side: str) -> np.ndarray:
            order = np.argsort(places, kind="stable")
            return np.concatenate([[0], np.cumsum(weight[order])])[np.searchsorted(places[order], begins, side=side)]

        return up_to(first, "right") - up_to(last, "left")

    def search(self, words: int, shingles: np.ndarray, weights: np.ndarray, k: int, hits: np.ndarray, rows: np.ndarray) -> list[tuple]:
        """``(similarity, first word, words, item)`` of the matches in one text of ``words`` words.

        Windows have an item's size in words, or the text's if that is less. A window without a shingle of any item of
        its size has similarity 0, so only the others get a fingerprint.
        """
        _, starts, sizes = self.table[k]
        spread = starts[rows + 1] - starts[rows]
        at, size = np.repeat(hits, spread), sizes[np.repeat(starts[rows], spread) + _counting(spread)]
        total = np.concatenate([[0], np.cumsum(weights)])
        out = []
        for n in np.unique(size).tolist():
            own = at[size == n]
            runs = min(n, words) - k + 1
            # windows around the hits, as ranges of begins that do not touch: both ends rise with the hit
            first, last = np.maximum(own - (n - k), 0), np.minimum(own, max(words - n, 0))
            new = np.concatenate([[True], first[1:] > np.maximum.accumulate(last)[:-1] + 1])
            low, high = first[new], np.append(last[np.flatnonzero(new)[1:] - 1], last[-1])
            windows = np.repeat(low, high - low + 1) + _counting(high - low + 1)
            found = []
            for part in range(0, len(windows), WINDOWS):
                begins = windows[part : part + WINDOWS]
                # only the shingles that these windows cover
                base, end = int(begins[0]), int(begins[-1]) + runs
                need = np.zeros(end - base + 1, dtype=np.int64)
                np.add.at(need, begins - base, 1)
                np.add.at(need, begins - base + runs, -1)
                used = base + np.flatnonzero(np.cumsum(need[:-1]) > 0)
                prints = _fingerprints(shingles[used], weights[used], np.searchsorted(used, begins), np.full(len(begins), runs))
                row, item = self.near(prints, n)
                found.append(np.stack([item, begins[row]]))
            item, begin = np.concatenate(found, axis=1)
            for i in np.unique(item[self.k[item] == k]).tolist():
                begins = begin[item == i]
                both = self.shared(i, shingles, own, begins, runs)
                every = total[begins + runs] - total[begins] + self.weight[i] - both
                for j in np.flatnonzero(100 * both >= self.spec.percent * every).tolist():
                    out.append((int(both[j]) / int(every[j]), int(begins[j]), min(n, words), i))
        return out


def _counting(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each size, one after another."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _apart(found: list[tuple]) -> list[tuple]:
    """Of the overlapping windows of one item the best one, the first of equals."""
    out: list[tuple] = []
    for hit in sorted(found, key=lambda h: (h[3], -h[0], h[1])):
        if not any(h[3] == hit[3] and h[1] < hit[1] + hit[2] and hit[1] < h[1] + h[2] for h in out):
            out.append(hit)
    return out


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of lower-cased texts without punctuation, their byte places, and each text's first word."""
    raw, offsets = buffers(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")))
    begins, ends = word_spans(raw, offsets, MARKS)
    return word_hashes(raw, begins, ends, KEEP), np.searchsorted(begins, offsets), begins, ends


_BUILT: dict[str, Index] = {}


def _index_of(name: str, shared) -> Index:
    """The index of a block, built once in each worker; the one of the block before makes room."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Index(*shared.value)
    return _BUILT[name]


def _searcher(name: str, shared):
    """Arrow batches of ``doc_id, text`` to ``doc_id, item_id, first_word, n_words, similarity``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index = _index_of(name, shared)
            for part in text_parts(batch, 1):
                rows, found = _hits(index, part.column(1))
                # a row for each id of an item
                copies = [len(index.ids[h[3]]) for h in found]
                ids = [i for h in found for i in index.ids[h[3]]]
                rows, found = ([x for x, n in zip(xs, copies, strict=True) for _ in range(n)] for xs in (rows, found))
                made = [
                    part.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(ids, pa.int64()),
                    pa.array([h[1] for h in found], pa.int64()),
                    pa.array([h[2] for h in found], pa.int64()),
                    pa.array([h[0] for h in found], pa.float64()),
                ]
                yield pa.record_batch(made, names=["doc_id", "item_id", "first_word", "n_words", "similarity"])

    return run


def _hits(index: Index, texts: pa.Array) -> tuple[list[int], list[tuple]]:
    """The matches of some texts: the row of each, and what ``Index.search`` says."""
    rows, found = [], []
    words, bounds, begins, ends = _words(texts)
    for k in index.sizes:
        shingles, weights = shingle_hashes(words, k), run_sums(ends - begins, k)
        places, keys = index.members(shingles, k)
        owners = np.searchsorted(bounds, places, side="right") - 1
        inside = places + k <= bounds[owners + 1]
        places, keys, owners = places[inside], keys[inside], owners[inside]
        for text, low, high in _runs(owners):
            a, b = bounds[text], bounds[text + 1]
            own = slice(a, b - k + 1)
            for hit in _apart(index.search(int(b - a), shingles[own], weights[own], k, places[low:high] - a, keys[low:high])):
                rows.append(text)
                found.append(hit)
    return rows, found


def _runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    edges = np.flatnonzero(np.diff(values, prepend=-1, append=-1))
    for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(values[low]), low, high


def item_words(rows: list[tuple]) -> tuple[list, list, list]:
    """Ids, word hashes and word sizes of items ``(item_id, text)``; texts that normalise alike are one item."""
    kept: dict[bytes, tuple] = {}
    for item_id, text in rows:
        words, _, begins, ends = _words(pa.array([text], pa.large_string()))
        if len(words):
            kept.setdefault(words.tobytes(), ([], words, ends - begins))[0].append(item_id)
    ids, items, lengths = ([v[i] for v in kept.values()] for i in range(3))
    return [sorted(i, key=lambda x: (x is None, x or 0)) for i in ids], items, lengths


def build_index(rows: list[tuple], spec: Contamination) -> Index | None:
    ids, items, lengths = item_words(rows)
    return Index(spec, ids, items, lengths) if items else None


def contaminated(
    docs: DataFrame, benchmark: DataFrame, spec: Contamination = Contamination(), id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """``doc_id, item_id, first_word, n_words, similarity``: the passages of ``docs`` that match a benchmark item.

    Texts are lower-cased, and white space and ASCII punctuation separate words. For every item size, each window of
    so many words that holds a shingle of such an item gets a weighted SimHash; blocks of the fingerprints find all
    items of that size within the radius, and weighted Jaccard similarity of the shingle bags decides. Of overlapping
    matches of one item the best is given. An item with fewer words than a shingle matches only as a whole.

    Documents stay where they are: the benchmark, in blocks of bounded size, goes to them, so no row is shuffled.
    Null or wordless texts and items match nothing; items that normalise alike are searched once and reported under
    each of their ids, a null one too; a null ``doc_id`` is kept; repeated documents are each reported, repeated items
    once; other columns are ignored; an empty table on either side gives no rows.
    """
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), as_text(F.col(text_col)).alias("text"))
    items = items.distinct()
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    texts = docs.select(F.col(id_col).alias("doc_id"), as_text(F.col(text_col)).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, item_id long, first_word long, n_words long, similarity double"
    out = texts.select("doc_id").where(F.lit(False)).select("doc_id", *[F.lit(None).cast(t).alias(c) for c, t in (("item_id", "long"), ("first_word", "long"), ("n_words", "long"), ("similarity", "double"))])
    for block in range(blocks):
        # items that normalise alike are in one block: the hash of their words chooses it
        plain = F.regexp_replace(F.lower("text"), "[\\x00-/:-@\\[-`{-\\x7f]+", "")
        own = items.where(F.pmod(F.xxhash64(plain), F.lit(blocks)) == block).collect()
        ids, words, lengths = item_words([(r["item_id"], r["text"]) for r in own])
        if ids:
            shared = docs.sparkSession.sparkContext.broadcast((spec, ids, words, lengths))
            found = texts.mapInArrow(_searcher(uuid.uuid4().hex, shared), schema)
            out = found if blocks == 1 else out.union(found)
    return out
