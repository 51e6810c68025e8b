"""Whole Arrow batches of texts to word hashes and shingle hashes, in numpy.

Words are runs of bytes other than space and tab to carriage return; A-Z may be lower-cased. Equal words get equal
64-bit hashes wherever they stand: a word's hash is its slice of one running sum of byte values times powers of an
odd base, shifted back to position zero. Buffers are worked through in blocks, so memory does not grow with a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: White space and ASCII punctuation: between words when only letters, digits and other characters count.
MARKS = SPACE.copy()
MARKS[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
KEEP = np.arange(256, dtype=np.uint8)
LOWER = KEEP.copy()
LOWER[ord("A") : ord("Z") + 1] += 32

#: Bytes whose running sums are made at once; they fit a core's cache.
BLOCK = 1 << 16
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SEED = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_POWER.get("up", ())) < n:
        _POWER["up"] = _powers(int(BASE), n)
        _POWER["down"] = _powers(pow(int(BASE), -1, 1 << 64), n)
    return _POWER["up"], _POWER["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the n + 1 places where its texts begin and end; a null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    low, high = (int(places[0]), int(places[-1])) if len(column) else (0, 0)
    raw = np.frombuffer(data, dtype=np.uint8)[low:high] if data is not None and high > low else np.zeros(0, np.uint8)
    return raw, places - low if len(column) else np.zeros(1, np.int64)


def word_spans(raw: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions of the words of all texts: begins and ends. No word reaches over the end of a text."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~gaps[raw]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    heads = offsets[:-1][offsets[:-1] < len(raw)]
    first[heads] = inside[heads]
    tails = offsets[1:][offsets[1:] > 0] - 1
    last[tails] = inside[tails]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray, fold: np.ndarray = LOWER) -> np.ndarray:
    """A 64-bit hash of every word, block by block; ``fold`` maps each byte first."""
    out = np.empty(len(begins), dtype=np.uint64)
    values = fold.astype(np.uint64) + np.uint64(1)
    at = 0
    while at < len(begins):
        low = int(begins[at])
        to = max(int(np.searchsorted(ends, low + BLOCK, side="right")), at + 1)
        high = int(ends[to - 1])
        up, down = _tables(high - low + 1)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.multiply(values[raw[low:high]], up[: high - low], out=sums[1:])
        np.cumsum(sums, out=sums)
        a, b = begins[at:to] - low, ends[at:to] - low
        out[at:to] = (sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64) * _SEED
        at = to
    return mix(out)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for every run of ``k`` words, by its first word; runs over the end of a text are in there too."""
    if len(words) < k:
        return np.zeros(0, dtype=np.uint64)
    up, _ = _tables(k + 1)
    n = len(words) - k + 1
    out = words[:n].copy()
    for j in range(1, k):
        out += words[j : j + n] * up[j]
    return mix(out)


def texts_words(raw: np.ndarray, offsets: np.ndarray, fold: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and for each text the place of its first word (n + 1 places)."""
    begins, ends = word_spans(raw, offsets)
    return word_hashes(raw, begins, ends, fold), np.searchsorted(begins, offsets)


def shingle_sets(words: np.ndarray, bounds: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingles of ``k`` words; of fewer words, all of them as one shingle."""
    every = shingle_hashes(words, k)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(every[a : b - k + 1])
        elif b > a:
            yield shingle_hashes(words[a:b], b - a)
        else:
            yield words[a:a]


class MinHash:
    """Seeded minimum hashes of sets of 64-bit values, many sets at a time."""

    def __init__(self, count: int, seed: int):
        rng = np.random.default_rng(seed)
        self.flip = rng.integers(0, 1 << 32, count, dtype=np.uint32)
        self.odd = rng.integers(0, 1 << 32, count, dtype=np.uint32) | np.uint32(1)

    def __call__(self, values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """One row of minima per set; ``bounds`` are the n + 1 places of the sets, none of them empty."""
        low = values.astype(np.uint32)
        high = (values >> np.uint64(32)).astype(np.uint32)
        out = np.empty((len(bounds) - 1, len(self.flip)), dtype=np.uint32)
        work, shift = np.empty_like(low), np.empty_like(low)
        for i, (flip, odd) in enumerate(zip(self.flip, self.odd, strict=True)):
            np.bitwise_xor(low, flip, out=work)
            np.multiply(work, odd, out=work)
            np.right_shift(work, np.uint32(15), out=shift)
            np.bitwise_xor(work, shift, out=work)
            np.add(work, high, out=work)
            np.multiply(work, np.uint32(0x846CA68B), out=work)
            out[:, i] = np.minimum.reduceat(work, bounds[:-1])
        return out


def minhash_sets(sets: list[np.ndarray], hashes: MinHash, block: int = 1 << 16) -> np.ndarray:
    """Minima of many sets, worked through in blocks that fit the processor's cache where the sets allow it."""
    out = np.empty((len(sets), len(hashes.flip)), dtype=np.uint32)
    at = 0
    while at < len(sets):
        to, size = at, 0
        while to < len(sets) and (to == at or size + len(sets[to]) <= block):
            size += len(sets[to])
            to += 1
        bounds = np.cumsum([0] + [len(s) for s in sets[at:to]])
        out[at:to] = hashes(np.concatenate(sets[at:to]), bounds)
        at = to
    return out
