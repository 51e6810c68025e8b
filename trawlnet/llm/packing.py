"""Sequences of equal size from documents of any size, by multiway differencing of their pieces."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawlnet.llm.segments import by_bytes, word_ends
from trawlnet.llm.shared import as_text, written
from trawlnet.llm.token_counts import Tokenizer

#: Bytes of text encoded at once.
SLICE_BYTES = 4 << 20


@dataclass(frozen=True)
class Packing:
    """Windows hold ``capacity`` ids. Documents fill whole windows first; what is left of each is cut into pieces of at
    most ``most_piece`` ids. ``windows`` windows are filled together from the pieces of a cell, ``spare`` ids a window
    being left free so that near-equal sums fit; ``cell_tokens`` ids make a cell. ``end_id`` ends every document."""

    capacity: int = 2048
    most_piece: int = 256
    windows: int = 128
    spare: int = 8
    cell_tokens: int = 4_000_000
    end_id: int = 1


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each size: Karmarkar-Karp differencing into ``windows`` sets with near-equal sums.

    Every size begins as a partial partition of its own. The two partitions with the largest imbalance are merged, the
    largest sum of one with the smallest of the other, until one is left. Sums are kept above the lowest one; the sets
    are kept as a forest, whose nodes join what two partitions had in one window. A partition is stored without the
    windows that it leaves empty, which come first, so many small sizes take little memory.
    """
    if not len(sizes):
        return np.zeros(0, np.int64)
    heap = [(-size if windows > 1 else 0, i) for i, size in enumerate(sizes.tolist())]
    heapq.heapify(heap)
    parts: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def lowest() -> tuple[np.ndarray, np.ndarray]:
        """The partition with the largest imbalance, which leaves the heap."""
        imbalance, i = heapq.heappop(heap)
        own_sums, own_nodes = parts.pop(i) if i in parts else ([-imbalance], [i])
        sums, nodes = np.zeros(windows, np.int64), np.full(windows, -1, np.int64)
        sums[windows - len(own_sums) :], nodes[windows - len(own_nodes) :] = own_sums, own_nodes
        return sums, nodes

    n_nodes, joins = len(sizes), []
    name = len(sizes)
    while len(heap) > 1:
        (a_sums, a_nodes), (b_sums, b_nodes) = lowest(), lowest()
        sums, b_nodes = a_sums + b_sums[::-1], b_nodes[::-1]
        both = (a_nodes >= 0) & (b_nodes >= 0)
        nodes = np.maximum(a_nodes, b_nodes)
        if both.any():
            made = np.arange(n_nodes, n_nodes + int(both.sum()))
            joins.append((made, a_nodes[both], b_nodes[both]))
            nodes[both] = made
            n_nodes += len(made)
        order = np.argsort(sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        used = int(np.argmax(nodes >= 0))
        parts[name] = (sums - sums[0])[used:].copy(), nodes[used:].copy()
        heapq.heappush(heap, (-int(sums[-1] - sums[0]), name))
        name += 1
    _, nodes = lowest()
    window = np.full(n_nodes, -1, np.int64)
    used = nodes >= 0
    window[nodes[used]] = np.flatnonzero(used)
    for made, a_nodes, b_nodes in reversed(joins):
        window[a_nodes] = window[made]
        window[b_nodes] = window[made]
    return window[: len(sizes)]


def fill(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each size, no window above ``capacity``: as few as the sum needs, more whenever one is exceeded."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differencing(sizes, windows)
        if np.bincount(window, weights=sizes, minlength=1).max() <= capacity:
            return window
        windows += 1


def crc32_of(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))


_PARTS = "start long, length long, ids_crc32 long, ids array<int>, doc_tokens long"


def _cut(tokenizer: Tokenizer, spec: Packing):
    """Arrow batches of ``doc_id, text`` to whole windows of a document, with their digest, and the ids of its rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ends(tokenizer.data)
        for batch in batches:
            for part in by_bytes(batch, 1, SLICE_BYTES):
                ids, counts = encoder(part.column(1))
                ends = np.cumsum(counts)
                totals = counts + 1
                whole, rest = np.divmod(totals, spec.capacity)
                # a row for each whole window and one for the rest
                n = whole + (rest > 0)
                doc = np.repeat(np.arange(len(n)), n)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * spec.capacity
                length = np.minimum(totals[doc] - start, spec.capacity)
                crcs, lists = [], []
                for d, low, size in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True):
                    first = int(ends[d] - counts[d])
                    own = ids[first + low : first + min(low + size, int(counts[d]))]
                    if low + size == totals[d]:
                        own = np.append(own, np.int32(spec.end_id))
                    full = size == spec.capacity
                    crcs.append(crc32_of(own) if full else None)
                    lists.append(None if full else own)
                made = [
                    part.column(0).take(pa.array(doc)),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crcs, pa.int64()),
                    pa.array(lists, pa.list_(pa.int32())),
                    pa.array(totals[doc], pa.int64()),
                ]
                yield pa.record_batch(made, names=["doc_id", "start", "length", "ids_crc32", "ids", "doc_tokens"])

    return run


def _groups(sizes: np.ndarray, spec: Packing) -> np.ndarray:
    """Places where the running sum of ids reaches as many as are packed together, and its end."""
    target = spec.windows * (spec.capacity - spec.spare)
    total = int(sizes.sum())
    return np.append(np.arange(target, total, target), total)


def _pieces(sizes: np.ndarray, spec: Packing) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents' rests cut at every ``most_piece`` ids and where a group ends: owner, start within the rest, and group."""
    ends = np.cumsum(sizes)
    begins = ends - sizes
    parts = -(-sizes // spec.most_piece)
    owner = np.repeat(np.arange(len(sizes)), parts)
    inner = begins[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)) * spec.most_piece
    groups = _groups(sizes, spec)
    cuts = np.union1d(inner, groups[:-1])
    owner = np.searchsorted(ends, cuts, side="right")
    return owner, cuts - begins[owner], np.searchsorted(groups, cuts, side="right")


def _pack(spec: Packing, names: list[str]):
    """One cell, whole windows and rests, to its pieces with window and place. A cell has ``cell_tokens`` ids, about."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        full = table.filter(pc.is_null(table["ids"]))
        rests = table.filter(pc.is_valid(table["ids"]))
        sizes = rests["length"].to_numpy()
        flat = rests["ids"].combine_chunks().flatten().to_numpy() if rests.num_rows else np.zeros(0, np.int32)
        owner, start, group = _pieces(sizes, spec)
        begins = np.cumsum(sizes) - sizes
        at = begins[owner] + start
        length = np.diff(np.append(at, sizes.sum()))
        window, used = np.zeros(len(at), np.int64), full.num_rows
        for g in range(int(group[-1]) + 1 if len(group) else 0):
            own = np.flatnonzero(group == g)
            chosen = fill(length[own], spec.capacity)
            # windows that stay empty have no number
            _, window[own] = np.unique(chosen, return_inverse=True)
            window[own] += used
            used += len(np.unique(chosen))
        order = np.lexsort((at, window))
        at, length, owner, start, window = (x[order] for x in (at, length, owner, start, window))
        offset = np.cumsum(length) - length
        first = np.searchsorted(window, window) if len(window) else window
        offset = offset - offset[first] if len(window) else offset
        crcs = [crc32_of(flat[a : a + n]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
        cell = int(table["cell"][0].as_py()) << 32
        # without the ids, which every piece of a rest would copy whole
        rest = rests.drop_columns("ids").take(pa.array(owner))
        packed = [
            rest["doc_id"].combine_chunks(),
            pa.array(rest["start"].to_numpy() + start, pa.int64()),
            pa.array(length, pa.int64()),
            pa.array(crcs, pa.int64()),
            rest["doc_tokens"].combine_chunks(),
            pa.array(window + cell, pa.int64()),
            pa.array(offset, pa.int64()),
        ]
        whole = [full[c].combine_chunks() for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
        whole += [pa.array(np.arange(full.num_rows) + cell, pa.int64()), pa.array(np.zeros(full.num_rows, np.int64))]
        return pa.concat_tables([pa.table(whole, names=names), pa.table(packed, names=names)])

    return run


def pack(docs: DataFrame, tokenizer: Tokenizer, spec: Packing = Packing(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``: every piece of every document, once.

    A document is the ids of its text and ``end_id``. ``start`` counts its ids before a piece, ``offset`` the ids before
    it in its sequence. Each ``capacity`` ids of a document are a sequence of their own; the rests are dealt by row to
    cells of bounded size, and in a cell, group by group, differencing gives windows with near-equal sums. A sequence is
    named by its cell, times 2**32, and its number there.

    A null or empty text is ``end_id`` alone; a null id is kept; rows that repeat an id or a text are documents of their
    own; a very long text is many whole windows and one rest, so it fills no cell; other columns are ignored; an empty
    table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), as_text(F.col(text_col)).alias("text"))
    cut = texts.mapInArrow(_cut(tokenizer, spec), f"doc_id {kind}, {_PARTS}")
    cut = written(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    total = cut.where("ids is not null").agg(F.sum("length")).first()[0] or 0
    rows = cut.where("ids is null").count()
    # whole windows are narrow rows: a cell may hold many more of those
    cells = max(1, -(-total // spec.cell_tokens), -(-rows // spec.cell_tokens))
    placed = cut.withColumn("cell", F.pmod(F.xxhash64("row"), F.lit(cells)))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return placed.groupBy("cell").applyInArrow(_pack(spec, names), schema)
