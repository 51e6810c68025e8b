"""Embedders: named functions from texts to fixed-size vectors, applied map-side in Arrow batches."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from trawlnet.functions.words import coded_words, text_slices

VECTOR = ArrayType(FloatType())
HASH_DIM = 64
# Text hashed at once: smaller slices hash the same words more often.
SLICE_BYTES = 12 << 20


@dataclass(frozen=True)
class Embedder:
    """A name and dimension recorded with every collection, and the column that makes vectors."""

    name: str
    dim: int
    column: Callable[[Column], Column]

    def add(self, df: DataFrame, text_col: str = "text", out_col: str = "embedding") -> DataFrame:
        return df.withColumn(out_col, self.column(F.col(text_col)))


def unpack_reply(reply: dict | Sequence, expected: int) -> Sequence:
    """Vectors of a model reply: a plain list, ``{"embeddings": [...]}`` or one ``{"embedding": [...]}``."""
    if isinstance(reply, dict):
        vectors = reply.get("embeddings")
        if vectors is None:
            if reply.get("embedding") is None:
                raise ValueError("reply holds neither 'embeddings' nor 'embedding'")
            vectors = [reply["embedding"]]
    else:
        vectors = reply
    if len(vectors) != expected:
        raise ValueError(f"embedder returned {len(vectors)} vectors for {expected} texts")
    return vectors


def function_embedder(name: str, dim: int, fn: Callable[[list[str]], dict | Sequence]) -> Embedder:
    """Wrap a batch function; Arrow batches bound each call. ``fn`` must be safe to repeat on task retry.

    The column is marked non-deterministic, as is the hashing one, so that Spark computes it once
    where it stands instead of again inside every filter it would push below it.
    """

    @F.pandas_udf(VECTOR)
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = batch.tolist()
            vectors = unpack_reply(fn(texts), len(texts)) if texts else []
            for v in vectors:
                if len(v) != dim:
                    raise ValueError(f"embedder {name} returned a vector of size {len(v)}, not {dim}")
            yield pd.Series([np.asarray(v, dtype="float32") for v in vectors], index=batch.index, dtype=object)

    return Embedder(name, dim, call.asNondeterministic())


def token_bucket(token: str, dim: int) -> int:
    return int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % dim


def hash_vectors(texts: pa.Array, dim: int) -> np.ndarray:
    """Count words per hash bucket and scale each row to unit length; a text without words stays zero.

    A batch is cut into words a few MB at a time, so memory does not follow the length of its texts.
    """
    made = [_hash_slice(texts[some], dim) for some in text_slices(texts, SLICE_BYTES)]
    return np.concatenate(made) if made else np.zeros((0, dim))


def _hash_slice(texts: pa.Array, dim: int) -> np.ndarray:
    rows, codes, words = coded_words(texts)
    buckets = np.array([token_bucket(w, dim) for w in words], dtype=np.int64)  # each distinct word once per slice
    counts = np.bincount(rows * dim + buckets[codes], minlength=len(texts) * dim).astype("float64")
    counts = counts.reshape(len(texts), dim)
    norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
    return np.divide(counts, norms, out=np.zeros_like(counts), where=norms > 0)


def hashing_embedder(dim: int = HASH_DIM) -> Embedder:
    """Deterministic feature hashing: no model, no shuffle, equal for equal word multisets."""

    @F.arrow_udf(VECTOR)
    def hashed(batch: pa.Array) -> pa.Array:
        vectors = hash_vectors(batch, dim).astype("float32")
        offsets = np.arange(len(batch) + 1, dtype="int32") * dim
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(vectors.ravel()))

    return Embedder(f"hash{dim}", dim, hashed.asNondeterministic())


_REGISTRY: dict[str, Embedder] = {}


def register(embedder: Embedder) -> Embedder:
    known = _REGISTRY.setdefault(embedder.name, embedder)
    if known.dim != embedder.dim:
        raise ValueError(f"embedder {embedder.name} is registered with dimension {known.dim}")
    return known


def resolve(which: str | Embedder | None = None) -> Embedder:
    """An embedder by name or object; the hashing embedder when none is given."""
    if isinstance(which, Embedder):
        return which
    if which is None:
        return DEFAULT
    if which not in _REGISTRY:
        raise KeyError(f"no embedder named {which!r}; known: {sorted(_REGISTRY)}")
    return _REGISTRY[which]


DEFAULT = register(hashing_embedder())


def check_dimension(df: DataFrame, dim: int, vector_col: str = "embedding") -> DataFrame:
    """Fail the job when any vector has another size."""
    message = F.concat(F.lit(f"expected {dim} values, got "), F.size(vector_col).cast("string"))
    checked = F.when(F.size(vector_col) == dim, F.col(vector_col)).otherwise(F.raise_error(message))
    return df.withColumn(vector_col, checked.cast(VECTOR))


def bucket_weights(df: DataFrame, *keep: str, vector_col: str = "embedding") -> DataFrame:
    """Long form of the non-zero weights: ``keep..., bucket, weight``."""
    return (
        df.select(*keep, F.posexplode_outer(vector_col).alias("bucket", "_w"))
        .where("_w <> 0")
        .select(*keep, "bucket", F.round(F.col("_w").cast("double"), 6).alias("weight"))
    )
