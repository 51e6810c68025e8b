"""Best k rows per query out of a score matrix: the numpy kernel the retrieval jobs run inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

DECIMALS = 6
_ROUNDING_ROOM = 1e-6
_BLOCK_CELLS = 1_000_000  # 8 MB of float64 scores at a time


def pick(
    costs: np.ndarray, ids: np.ndarray, k: int, cut: np.ndarray, floor: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the k lowest ``(rounded cost, id)`` per row at or below ``cut``: (row, column, cost).

    ``inf`` means "not a candidate". Ties at the k-th cost go to the lower id, so any split of
    the rows into blocks merges to the same answer. Only what may survive is rounded.
    """
    if costs.shape[1] > k and not np.isfinite(cut).all():
        cut = np.minimum(cut, _rounded(np.partition(costs, k - 1, axis=1)[:, k - 1], floor))
    flat = np.flatnonzero(costs <= (cut + np.maximum(_ROUNDING_ROOM, 1e-12 * np.abs(np.where(np.isfinite(cut), cut, 0))))[:, None])
    values = _rounded(costs.ravel()[flat], floor)
    rows, cols = np.divmod(flat, costs.shape[1])
    kept = (values <= cut[rows]) & np.isfinite(values)
    rows, cols, values = rows[kept], cols[kept], values[kept]
    return keep_k(rows, cols, values, ids[cols], k)


def _rounded(costs: np.ndarray, floor: float) -> np.ndarray:
    return np.round(np.maximum(costs, floor), DECIMALS)


def keep_k(rows, cols, values, ids, k):
    _, id_rank = np.unique(ids, return_inverse=True)
    order = np.lexsort((id_rank, values, rows))
    rows, cols, values = rows[order], cols[order], values[order]
    first = np.r_[True, rows[1:] != rows[:-1]] if len(rows) else np.zeros(0, bool)
    position = np.arange(len(rows)) - np.maximum.accumulate(np.where(first, np.arange(len(rows)), 0))
    kept = position < k
    return rows[kept], cols[kept], values[kept]


def without_spare_copies(x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that can still be hits: of equal vectors only the k lowest ids, so copies cannot pile up as ties."""
    if x.size == 0:
        return x, ids
    whole_rows = np.ascontiguousarray(x).view(np.dtype((np.void, x.itemsize * x.shape[1]))).ravel()
    distinct, group = np.unique(whole_rows, return_inverse=True)
    if len(distinct) == len(x):
        return x, ids
    _, kept, _ = keep_k(group, np.arange(len(x)), np.zeros(len(x)), ids, k)
    return x[kept], ids[kept]


class RunningTopK:
    """Keeps the best k per query over any number of batches in O(queries * k) memory.

    ``floor`` is the least possible cost; float noise below it is lifted to it.
    """

    def __init__(self, n_queries: int, k: int, floor: float = 0.0):
        self.k, self.floor = k, floor
        self.rows = np.zeros(0, dtype=np.int64)
        self.ids = None
        self.costs = np.zeros(0)
        self.cut = np.full(n_queries, np.inf)
        self.found: list[tuple] = []

    def offer(self, score_block, n_items: int, ids: np.ndarray, members: np.ndarray | None = None) -> None:
        """``score_block(query_positions)`` gives costs of those queries against the batch."""
        self.gather(score_block, n_items, ids, members)
        self.merge()

    def gather(self, score_block, n_items: int, ids: np.ndarray, members: np.ndarray | None = None) -> None:
        """Like ``offer``, but what is found waits for one ``merge``, so that many small batches cost one."""
        members = np.arange(len(self.cut)) if members is None else members
        step = max(1, _BLOCK_CELLS // max(1, n_items))
        for start in range(0, len(members), step):
            part = members[start : start + step]
            rows, cols, values = pick(score_block(part), ids, self.k, self.cut[part], self.floor)
            self.found.append((part[rows], ids[cols], values))

    def merge(self) -> None:
        if not self.found:
            return
        found, self.found = self.found, []
        rows = np.concatenate([self.rows] + [f[0] for f in found])
        new_ids = np.concatenate(([] if self.ids is None else [self.ids]) + [f[1] for f in found])
        costs = np.concatenate([self.costs] + [f[2] for f in found])
        self.rows, kept, self.costs = keep_k(rows, np.arange(len(rows)), costs, new_ids, self.k)
        self.ids = new_ids[kept]
        last = np.flatnonzero(np.bincount(self.rows, minlength=len(self.cut)) >= self.k)
        ends = np.searchsorted(self.rows, last, side="right") - 1
        self.cut[last] = self.costs[ends]


def squared_distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    d = q @ x.T
    d *= -2.0
    d += (q * q).sum(axis=1)[:, None]
    d += (x * x).sum(axis=1)[None, :]
    return d


def id_ranks(ids: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Place of every id among the distinct ids in Spark's order, nulls first, and those ids in that order."""
    rank = pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64) - 1
    _, first = np.unique(rank, return_index=True)
    return rank, ids.take(pa.array(first))


# Queries and items of one matrix product, items in whole words of _BITS; pairs whose distances are taken again at once.
_TILE_QUERIES, _TILE_ITEMS = 512, 2048
_EXACT_PAIRS = 16_384
_BITS = 64


class NearestVectors:
    """The k nearest items per query over any number of slices, in O(queries * k) memory.

    A tile of distances is one float32 matrix product that holds the norms of both sides. Only pairs that may lie at or
    below a query's k-th distance, given the greatest possible rounding error, are taken again in float64.
    """

    def __init__(self, queries: np.ndarray, k: int):
        self.q, self.k = queries, k
        self.norms = (queries * queries).sum(axis=1)
        self.costs = np.full((len(queries), k), np.inf)
        self.ranks = np.full((len(queries), k), -1, dtype=np.int64)
        self.scale = 0.0  # the greatest length so far: in its units nothing overflows float32
        self.tile = np.empty(_TILE_QUERIES * _TILE_ITEMS, dtype="float32")
        self.near = np.empty(_TILE_QUERIES * _TILE_ITEMS, dtype=bool)

    def _rescale(self, longest: float) -> None:
        longest = max(longest, float(np.sqrt(self.norms.max(initial=0.0))), 1e-12)
        if longest > self.scale:
            self.scale = longest
            self.single = np.empty((len(self.q), self.q.shape[1] + 2), dtype="float32")
            self.single[:, :-2] = self.q * (-2.0 / longest)
            self.single[:, -2] = self.norms / longest**2
            self.single[:, -1] = 1.0

    def offer(self, x: np.ndarray, ranks: np.ndarray) -> None:
        """Items with their ``id_ranks``; ties at the k-th distance go to the lower one."""
        if not len(self.q) or not len(x):
            return
        if x.shape[1] != self.q.shape[1]:
            raise ValueError("vectors of different sizes cannot be compared")
        if len(self.q) >= 64:  # from so many queries on, looking for equal vectors costs less than scoring the copies
            x, ranks = without_spare_copies(x, ranks, self.k)
        norms = (x * x).sum(axis=1)
        longest = float(np.sqrt(norms.max()))
        self._rescale(longest)
        single = np.zeros((-(-len(x) // _BITS) * _BITS, x.shape[1] + 2), dtype="float32")
        single[: len(x), :-2] = x / self.scale
        single[:, -2] = 1.0
        single[:, -1] = np.inf  # what fills up the last word is never near
        single[: len(x), -1] = norms / self.scale**2
        # twice the bound of a float32 sum of so many products, whose absolute values sum to (|q| + |x|)^2 at most
        error = 4.0 * (x.shape[1] + 8) * 2.0**-24 * ((np.sqrt(self.norms) + longest) / self.scale) ** 2 + 1e-30
        for low in range(0, len(self.q), _TILE_QUERIES):
            part = slice(low, min(low + _TILE_QUERIES, len(self.q)))
            for left in range(0, len(x), _TILE_ITEMS):
                some = slice(left, min(left + _TILE_ITEMS, len(single)))
                self._tile(part, x[some], norms[some], ranks[some], single[some], error[part])

    def _tile(self, part: slice, x: np.ndarray, norms: np.ndarray, ranks: np.ndarray, single: np.ndarray, error: np.ndarray) -> None:
        n, width = part.stop - part.start, len(single)
        tile = self.tile[: n * width].reshape(n, width)
        np.matmul(self.single[part], single.T, out=tile)
        cut = self.costs[part, -1]
        open_ended = ~np.isfinite(cut)
        if open_ended.any() and len(x) > self.k:
            kth = np.partition(tile[open_ended], self.k - 1, axis=1)[:, self.k - 1]
            cut = cut.copy()
            cut[open_ended] = (kth + error[open_ended]) * self.scale**2
        finite = np.where(np.isfinite(cut), cut, 0.0)
        limit = (cut + np.maximum(_ROUNDING_ROOM, 1e-12 * np.abs(finite))) / self.scale**2 + error
        limit = np.minimum(np.nextafter(limit.astype("float32"), np.float32(np.inf)), np.finfo("float32").max)
        near = self.near[: n * width]
        np.less_equal(tile, limit[:, None], out=near.reshape(n, width))
        words = np.flatnonzero(np.packbits(near).view(np.uint64))  # few pairs are near, so most words are zero
        if not len(words):
            return
        flat = (words[:, None] * _BITS + np.arange(_BITS)).ravel()
        rows, cols = np.divmod(flat[near[flat]], width)
        q, q_norms = self.q[part], self.norms[part]
        if len(rows) * 4 > n * width:
            exact = squared_distances(q, x)[rows, cols]
        else:
            exact = np.empty(len(rows))
            for i in range(0, len(rows), _EXACT_PAIRS):
                r, c = rows[i : i + _EXACT_PAIRS], cols[i : i + _EXACT_PAIRS]
                exact[i : i + _EXACT_PAIRS] = -2.0 * np.einsum("ij,ij->i", q[r], x[c]) + q_norms[r] + norms[c]
        values = _rounded(exact, 0.0)
        kept = values <= self.costs[part, -1][rows]
        self._merge(part, rows[kept], values[kept], ranks[cols[kept]])

    def _merge(self, part: slice, rows: np.ndarray, values: np.ndarray, ranks: np.ndarray) -> None:
        if not len(rows):
            return
        touched, at = np.unique(rows, return_inverse=True)
        held = part.start + touched
        at = np.r_[np.repeat(np.arange(len(touched)), self.k), at]
        costs = np.r_[self.costs[held].ravel(), values]
        ranks = np.r_[self.ranks[held].ravel(), ranks]
        order = np.lexsort((ranks, costs, at))
        starts = np.searchsorted(at[order], np.arange(len(touched)))
        best = order[(starts[:, None] + np.arange(self.k)).ravel()]  # every query has k entries at least
        self.costs[held], self.ranks[held] = costs[best].reshape(-1, self.k), ranks[best].reshape(-1, self.k)

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query position, id rank, cost) of all hits."""
        rows, cols = np.nonzero(np.isfinite(self.costs))
        return rows, self.ranks[rows, cols], self.costs[rows, cols]
