"""Values that meet in packed blocks: a row holds the values of one part as bytes, so Spark moves few rows, and a task
sorts its values in numpy.

A part is a range of hashes, so equal values meet in one task. What is found there can be marked in bits that every task
gets: a filter without misses, which lets through few others. Its size has a bound, whatever the number of values.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

#: Values of a part, about, at most; values that a task holds before it deals them out.
PART_VALUES, HELD_VALUES = 1 << 20, 1 << 21
#: Bits of a filter for a part, by how often a value has to be found, and of a whole filter at most (32 MB), as powers of two.
PART_BITS, MOST_BITS = {1: 24, 2: 21}, 28

Arrays = tuple[np.ndarray, ...]


def parts_of(values: int) -> int:
    """How many parts, a power of two, take so many values."""
    return 1 << min((values // PART_VALUES).bit_length(), 24)


def part_numbers(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of each hash, by its upper bits."""
    bits = parts.bit_length() - 1
    at = hashes >> np.uint64(64 - bits) if bits else np.zeros(len(hashes), np.uint64)
    return at.astype(np.uint16 if bits <= 16 else np.uint32)


def packed(column: np.ndarray, places: np.ndarray) -> pa.Array:
    """Neighbouring values as one binary each; ``places`` are the n + 1 places where those begin and end."""
    offsets = (places * column.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(column))])


def unpacked(column: pa.Array, kind) -> np.ndarray:
    """All values of a column of ``packed`` binaries."""
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, kind)
    places = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8)[places[0] : places[-1]].view(kind)


def dealt(blocks: Iterator[tuple[np.ndarray, Arrays]], parts: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Blocks of hashes with columns of values to a row for each part: ``part``, and the packed values of each column."""

    def batch(held: list[tuple[np.ndarray, Arrays]]) -> pa.RecordBatch:
        at = part_numbers(np.concatenate([h for h, _ in held]), parts)
        order = np.argsort(at, kind="stable")
        counts = np.bincount(at, minlength=parts)
        full = np.flatnonzero(counts)
        places = np.concatenate([[0], np.cumsum(counts[full])])
        columns = [packed(np.concatenate(x)[order], places) for x in zip(*[own for _, own in held], strict=True)]
        return pa.record_batch([pa.array(full.astype(np.int32)), *columns], names=["part", *names])

    held, n = [], 0
    for block in blocks:
        held.append(block)
        n += len(block[0])
        if n >= HELD_VALUES:
            yield batch(held)
            held, n = [], 0
    if n:
        yield batch(held)


def met(batches: Iterator[pa.RecordBatch], kinds: dict[str, type]) -> Arrays:
    """All values of a task's part, column by column."""
    held = {c: [np.zeros(0, kind)] for c, kind in kinds.items()}
    for batch in batches:
        for c, kind in kinds.items():
            held[c].append(unpacked(batch.column(c), kind))
    return tuple(np.concatenate(x) for x in held.values())


def _places(hashes: np.ndarray, parts: int, size: int) -> Arrays:
    """Two of ``size`` bits for each hash, both within the range of its part."""
    own = np.uint64(size // parts - 1)
    first = hashes >> np.uint64(64 - (size.bit_length() - 1))
    return first, (first & ~own) | (hashes & own)


@dataclass(frozen=True)
class Marks:
    """Bits of marked hashes."""

    parts: int
    bits: np.ndarray

    def have(self, hashes: np.ndarray) -> np.ndarray:
        """Which hashes may be marked: all that are, and few others."""
        a, b = _places(hashes, self.parts, len(self.bits) * 8)
        out = self._bit(a)
        left = np.flatnonzero(out)
        out[left] = self._bit(b[left])
        return out

    def _bit(self, at: np.ndarray) -> np.ndarray:
        return ((self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def _size(parts: int, least: int) -> int:
    """Bits of a filter, at least a byte for each part."""
    power = parts.bit_length() - 1
    return 1 << max(min(PART_BITS[least] + power, MOST_BITS), power + 3)


def marked(df: DataFrame, hashes: Callable[[pa.Array], np.ndarray], values: int, least: int = 1) -> Broadcast:
    """``Marks`` of the hashes of the one column of ``df`` that are found ``least`` (1 or 2) times or more. ``values``:
    about how many there are; ``hashes`` makes them of an Arrow column."""
    parts, size = parts_of(values), _size(parts_of(values), least)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (hashes(batch.column(0)) for batch in batches)
        return dealt(((x, (x,)) for x in found), parts, ["packed"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (every,) = met(batches, {"packed": np.uint64})
        if not len(every):
            return
        every = np.sort(every)
        again = every[1:] == every[:-1]
        found = every[1:][again] if least == 2 else every[np.append(True, ~again)]
        part = int(part_numbers(every[:1], parts)[0])
        bits = np.zeros(size // parts, dtype=bool)
        for at in _places(found, parts, size):
            bits[at & np.uint64(size // parts - 1)] = True
        own = np.packbits(bits, bitorder="little").tobytes()
        yield pa.record_batch([pa.array([part], pa.int32()), pa.array([own], pa.binary())], names=["part", "bits"])

    rows = df.mapInArrow(deal, "part int, packed binary").repartitionById(parts, "part").mapInArrow(mark, "part int, bits binary")
    out = Marks(parts, np.zeros(size // 8, np.uint8))
    for row in rows.collect():
        own = np.frombuffer(row["bits"], np.uint8)
        out.bits[row["part"] * len(own) : (row["part"] + 1) * len(own)] = own
    return df.sparkSession.sparkContext.broadcast(out)
