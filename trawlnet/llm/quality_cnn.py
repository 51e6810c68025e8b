"""A quality classifier: a byte-level convolutional network in numpy over whole texts."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawlnet.llm.shared import as_text
from trawlnet.llm.words import buffers

#: Texts are scored in groups of about so many windows, which bounds memory whatever the length of a text.
GROUP_WINDOWS = 1 << 13
#: A training batch of up to so many chunks is multiplied at once, some 150 MB; batches are a fraction of that where texts
#: have a few thousand bytes.
WHOLE_CHUNKS = 1 << 13


@dataclass(frozen=True)
class Shape:
    """Bytes are embedded; ``filters`` filters see windows of ``width`` bytes, one every ``stride`` bytes; their
    activations are averaged over overlapping chunks of ``chunk`` windows, one every ``step`` windows; ``hidden`` units
    see each chunk; the largest activation of each unit over all chunks of a text goes into one logistic unit."""

    embed: int = 6
    width: int = 12
    stride: int = 4
    filters: int = 48
    chunk: int = 32
    step: int = 16
    hidden: int = 24

    @property
    def chunk_bytes(self) -> int:
        return self.stride * (self.chunk - 1) + self.width


@dataclass(frozen=True)
class Training:
    """``most_rows``: bound of the labelled rows to learn from, those with the lowest hashes; ``most_bytes``: bound of
    their text, whole texts that would pass it are left out. Both bound what reaches the driver."""

    most_rows: int = 2_500
    most_bytes: int = 12_000_000
    epochs: int = 9
    batch: int = 64
    rate: float = 4e-3
    decay: float = 1e-4
    seed: int = 5


Params = dict[str, np.ndarray]


def start(shape: Shape, seed: int) -> Params:
    rng = np.random.default_rng(seed)

    def normal(*size, scale):
        return (rng.standard_normal(size) * scale).astype(np.float32)

    return {
        "embed": normal(257, shape.embed, scale=0.5),
        "conv": normal(shape.width * shape.embed, shape.filters, scale=(2 / (shape.width * shape.embed)) ** 0.5),
        "conv_bias": np.zeros(shape.filters, np.float32),
        "dense": normal(shape.filters, shape.hidden, scale=(2 / shape.filters) ** 0.5),
        "dense_bias": np.zeros(shape.hidden, np.float32),
        "out": normal(shape.hidden, scale=0.3),
        "out_bias": np.zeros(1, np.float32),
    }


def chunk_starts(n: int, shape: Shape) -> np.ndarray:
    """Where the chunks of a text of ``n`` bytes begin: overlapping, over the whole text, one at least."""
    hop = shape.step * shape.stride
    return np.arange(max(1, -(-max(n - shape.chunk_bytes, 0) // hop) + 1)) * hop


def chunk_codes(raw: np.ndarray, shape: Shape) -> np.ndarray:
    """The chunks of one text as rows of byte codes; code 256 pads the last one."""
    starts = chunk_starts(len(raw), shape)
    padded = np.full(int(starts[-1]) + shape.chunk_bytes, 256, dtype=np.int16)
    padded[: min(len(raw), len(padded))] = raw[: len(padded)]
    return np.lib.stride_tricks.sliding_window_view(padded, shape.chunk_bytes)[starts]


def _windows(codes: np.ndarray, p: Params, shape: Shape) -> np.ndarray:
    """Embedded windows of chunks, one row each: overlapping views are copied once, for the matrix product."""
    x = p["embed"][codes]
    view = np.lib.stride_tricks.sliding_window_view(x, shape.width, axis=1)[:, :: shape.stride]
    return np.ascontiguousarray(view.transpose(0, 1, 3, 2)).reshape(-1, shape.width * shape.embed)


def _chunk_units(codes: np.ndarray, p: Params, shape: Shape) -> tuple:
    windows = _windows(codes, p, shape)
    active = windows @ p["conv"]
    active += p["conv_bias"]
    np.maximum(active, 0, out=active)
    mean = active.reshape(len(codes), shape.chunk, shape.filters).mean(axis=1)
    return windows, active, mean, np.maximum(mean @ p["dense"] + p["dense_bias"], 0)


def _text_windows(raw: np.ndarray, offsets: np.ndarray, p: Params, shape: Shape) -> np.ndarray:
    """Hidden units of every text, each the largest over the text's chunks."""
    out = np.zeros((len(offsets) - 1, shape.hidden), np.float32)
    held, owners, size = [], [], 0

    def flush():
        if held:
            units = _chunk_units(np.concatenate(held), p, shape)[3]
            np.maximum.at(out, np.repeat([o for o, _ in owners], [n for _, n in owners]), units)
            held.clear()
            owners.clear()

    most = max(1, GROUP_WINDOWS // shape.chunk)
    for i in range(len(offsets) - 1):
        text = raw[offsets[i] : offsets[i + 1]]
        starts = chunk_starts(len(text), shape)
        for at in range(0, len(starts), most):  # a long text is worked through in pieces that share no chunk
            own = starts[at : at + most]
            end = int(own[-1]) + shape.chunk_bytes
            piece = text[int(own[0]) : end]
            codes = np.full(end - int(own[0]), 256, dtype=np.int16)
            codes[: len(piece)] = piece
            held.append(np.lib.stride_tricks.sliding_window_view(codes, shape.chunk_bytes)[own - own[0]])
            owners.append((i, len(own)))
            size += len(own)
            if size >= most:
                flush()
                size = 0
    flush()
    return out


def probabilities(raw: np.ndarray, offsets: np.ndarray, p: Params, shape: Shape) -> np.ndarray:
    """The probability of label 1 for each of many texts in one buffer."""
    logit = _text_windows(raw, offsets, p, shape).astype(np.float64) @ p["out"] + p["out_bias"][0]
    # products of other batch sizes differ in the last bits, which the layout of a table must not show
    return np.round(1 / (1 + np.exp(-np.clip(logit, -30, 30))), 6)


def _gradients(texts: list[np.ndarray], labels: np.ndarray, p: Params, shape: Shape) -> Params:
    """Gradients of the mean log loss over some texts, each given as chunk codes.

    Windows and activations take some 20 KB a chunk. Of more than ``WHOLE_CHUNKS`` chunks they are there for one group at
    a time, and again for those that have a gradient: ``hidden`` of each text at most, however long it is.
    """
    sizes = np.array([len(t) for t in texts])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    codes = np.concatenate(texts)
    whole, most = len(codes) <= WHOLE_CHUNKS, max(1, GROUP_WINDOWS // shape.chunk)
    if whole:
        seen, active, mean, units = _chunk_units(codes, p, shape)
    else:
        mean = np.concatenate([_chunk_units(codes[at : at + most], p, shape)[2] for at in range(0, len(codes), most)])
        units = np.maximum(mean @ p["dense"] + p["dense_bias"], 0)
    n, h = len(texts), shape.hidden
    best = np.empty((n, h), dtype=np.int64)
    for i in range(n):
        best[i] = units[bounds[i] : bounds[i + 1]].argmax(axis=0) + bounds[i]
    pooled = units[best, np.arange(h)]
    prob = 1 / (1 + np.exp(-np.clip(pooled @ p["out"] + p["out_bias"][0], -30, 30)))
    slope = ((prob - labels) / n).astype(np.float32)
    g: Params = {"out": pooled.T @ slope, "out_bias": slope.sum(keepdims=True)}
    back = np.zeros_like(units)
    np.add.at(back, (best.ravel(), np.tile(np.arange(h), n)), (slope[:, None] * p["out"]).ravel())
    back *= units > 0
    g["dense"], g["dense_bias"] = mean.T @ back, back.sum(axis=0)
    # chunks that are no unit's largest have no gradient
    used = np.flatnonzero(np.abs(back).sum(axis=1) > 0)
    if whole:
        # one after the other, as both are large
        seen = seen.reshape(len(codes), shape.chunk, -1)[used].reshape(-1, seen.shape[1])
        active = active.reshape(len(codes), shape.chunk, -1)[used].reshape(-1, shape.filters)
    else:
        seen, active = _chunk_units(codes[used], p, shape)[:2]
    into = np.repeat((back[used] @ p["dense"].T) / shape.chunk, shape.chunk, axis=0).reshape(len(used), shape.chunk, -1)
    into = into.reshape(-1, shape.filters)
    into *= active > 0
    g["conv"], g["conv_bias"] = seen.T @ into, into.sum(axis=0)
    del seen, active
    down = (into @ p["conv"].T).reshape(len(used), shape.chunk, shape.width, shape.embed)
    g["embed"] = np.zeros_like(p["embed"])
    for w in range(shape.width):
        places = codes[used][:, w : w + shape.stride * (shape.chunk - 1) + 1 : shape.stride]
        for e in range(shape.embed):
            g["embed"][:, e] += np.bincount(places.ravel(), weights=down[:, :, w, e].ravel(), minlength=257)
    return g


def train(texts: Sequence[bytes | np.ndarray], labels: np.ndarray, shape: Shape = Shape(), how: Training = Training()) -> Params:
    """Parameters learned with Adam from whole texts and labels 0 or 1; the same input gives the same result.

    Texts of one label only, or no text, still give a network; it then knows no more than the share of label 1.
    """
    p = start(shape, how.seed)
    share = (float(np.sum(labels)) + 1) / (len(labels) + 2)
    p["out_bias"][:] = np.log(share / (1 - share))
    raw = [np.frombuffer(t, np.uint8) for t in texts]
    rng = np.random.default_rng(how.seed)
    first, second, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    for epoch in range(how.epochs):
        order, rate = rng.permutation(len(raw)), how.rate * 0.5 * (1 + np.cos(np.pi * epoch / how.epochs))
        for at in range(0, len(order), how.batch):
            own = order[at : at + how.batch]
            step += 1
            # codes are four times a text: they are made for one batch
            for k, g in _gradients([chunk_codes(raw[i], shape) for i in own], labels[own], p, shape).items():
                g = g + how.decay * p[k]
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                p[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return p


def give_back() -> None:
    """Returns freed memory to the system where the C library can: what training has freed would stay with the driver."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def remainder(id_column: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id is in no fold."""
    return F.crc32(id_column.cast("string").cast("binary")) % folds


def learn(docs: DataFrame, labels: DataFrame, shape: Shape = Shape(), how: Training = Training(), text_col: str = "text") -> Params:
    """A network learned from a bounded sample of the labelled rows of ``docs`` that are not held out.

    ``labels`` has ``doc_id`` and ``quality``. Rows with a null id or label are skipped; of an id with several labels
    the lowest counts; repeated rows of an id count once. The sample is the rows with the lowest hashes of the id, so
    it does not depend on the layout of the tables.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.where(remainder(F.col("doc_id")) != 0)
    sample = known.orderBy(F.xxhash64(F.lit(how.seed), "doc_id"), "doc_id").limit(how.most_rows)
    # most_rows rows of two numbers: bounded
    rows = docs.select("doc_id", as_text(F.col(text_col)).alias("text")).join(F.broadcast(sample), "doc_id")
    # the size of each text first, so that the driver never receives more than most_bytes of text
    rows = rows.withColumn("at", F.xxhash64(F.lit(how.seed), "doc_id")).withColumn("bytes", F.octet_length("text"))
    sizes = rows.groupBy("doc_id").agg(F.max("bytes").alias("bytes"), F.min("at").alias("at")).orderBy("at", "doc_id").collect()
    fits, held = [], 0
    for r in sizes:
        if held + r["bytes"] <= how.most_bytes:
            held += r["bytes"]
            fits.append(r["doc_id"])
    fits_table = docs.sparkSession.createDataFrame([(i,) for i in fits], docs.select("doc_id").schema)
    rows = rows.join(F.broadcast(fits_table), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    # texts stay in the buffers in which they come, most_bytes at most
    found = rows.orderBy(F.xxhash64(F.lit(how.seed), "doc_id"), "doc_id").select("text", "quality").toArrow()
    texts = []
    for batch in found.to_batches():
        raw, places = buffers(batch.column(0))
        texts += [raw[a:b] for a, b in zip(places[:-1], places[1:], strict=True)]
    params = train(texts, found.column(1).to_numpy().astype(np.float32), shape, how)
    give_back()
    return params


def score(docs: DataFrame, params: Params, shape: Shape = Shape(), text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 of each whole text; a null text is scored as an empty one.

    Map-only: the parameters, some tens of kilobytes, go with the code. A column named like the result gives way.
    """

    @F.arrow_udf("double")
    def probability(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(probabilities(*buffers(batch), params, shape))

    return docs.withColumn(out_col, probability(as_text(F.col(text_col))))
