"""Token counts behind a digest cache: every distinct text is encoded once for each tokenizer version."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawlnet.llm.shared import as_text, digest, exists, spread_join, text_bytes, written

#: Texts are encoded in calls of about so many characters, which bounds what a call holds.
CALL_CHARS = 1 << 20
#: Digests of unseen texts are broadcast up to this many, 40 bytes each; beyond it they are shuffled.
UNSEEN_BROADCAST = 500_000
#: The word pattern of byte-level BPE vocabularies of this family.
WORD_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Tokenizer:
    """A vocabulary file as bytes, so that executors need no path, with the digest that versions the cache.

    ``.json`` files count as the ``tokenizers`` library does, ``.model`` as ``sentencepiece``, ``.tiktoken`` as
    ``tiktoken``: no begin, end or other added tokens; special strings inside texts as the library's default.
    """

    def __init__(self, path: str):
        self.kind = Path(path).suffix
        if self.kind not in (".json", ".model", ".tiktoken"):
            raise ValueError(f"no tokenizer library for {path}")
        self.data = Path(path).read_bytes()
        self.version = hashlib.sha256(self.kind.encode() + b"\0counts-1\0" + self.data).hexdigest()

    def counter(self) -> Callable[[list[str]], list[int]]:
        return {".json": _json_counter, ".model": _piece_counter, ".tiktoken": _rank_counter}[self.kind](self.data)


def _plain_byte_level(spec: dict) -> bool:
    """Whether a JSON vocabulary is byte-level BPE whose merges come in the order of their ids, and nothing else."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    if model.get("type", "BPE") != "BPE" or spec.get("normalizer") or spec.get("truncation") or spec.get("padding"):
        return False
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or split.get("use_regex") is False:
        return False
    if any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")):
        return False
    if any(t.get(k) for t in spec.get("added_tokens", ()) for k in ("lstrip", "rstrip", "single_word", "normalized")):
        return False
    vocab = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [vocab["".join(m)] for m in pairs]
    special = {t["content"] for t in spec.get("added_tokens", ())}
    return all(a < b for a, b in zip(ids, ids[1:], strict=False)) and len(vocab.keys() - special) == 256 + len(ids)


def _byte_of() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, turned around."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _json_counter(data: bytes) -> Callable[[list[str]], list[int]]:
    """The library itself, or for a plain byte-level vocabulary the same merges in a faster encoder."""
    spec = json.loads(data)
    if not _plain_byte_level(spec):
        return _library_counter(data)
    import tiktoken

    byte, special = _byte_of(), {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
    ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    encoding = tiktoken.Encoding("json", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens=special)
    library: list[Callable[[list[str]], list[int]]] = []

    def count(text: str) -> int:
        try:
            return len(encoding.encode(text, allowed_special="all"))
        except ValueError:
            # the faster encoder's pattern gives up on runs of some hundred thousand spaces
            if not library:
                library.append(_library_counter(data))
            return library[0]([text])[0]

    return lambda texts: [count(t) for t in texts]


def _library_counter(data: bytes) -> Callable[[list[str]], list[int]]:
    from tokenizers import Tokenizer as Library

    library = Library.from_str(data.decode())
    library.no_truncation()
    library.no_padding()
    return lambda texts: [len(e) for e in library.encode_batch_fast(texts, add_special_tokens=False)]


def _piece_counter(data: bytes) -> Callable[[list[str]], list[int]]:
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    return lambda texts: [len(ids) for ids in library.encode(texts, num_threads=1)] if texts else []


def _rank_counter(data: bytes) -> Callable[[list[str]], list[int]]:
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    encoding = tiktoken.Encoding("ranks", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [len(encoding.encode_ordinary(t)) for t in texts]


def _encode(tokenizer: Tokenizer):
    """Arrow batches of ``digest, content`` to ``digest, n_tokens``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for batch in batches:
            count = count or tokenizer.counter()
            texts, counts, held = [], [], 0
            for value in batch.column(1):
                texts.append(value.as_py())
                held += len(texts[-1])
                if held >= CALL_CHARS:
                    counts += count(texts)
                    texts, held = [], 0
            counts += count(texts) if texts else []
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    return run


def _cached(docs: DataFrame, cache: str, version: str) -> DataFrame | None:
    if not exists(docs.sparkSession, cache):
        return None
    stored = docs.sparkSession.read.schema("digest binary, n_tokens long, version string").parquet(cache)
    return stored.where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame,
    tokenizer: Tokenizer,
    cache: str,
    text_col: str = "text",
    normalise: Callable[[Column], Column] = lambda c: c,
    limit: int = 512,
) -> DataFrame:
    """The columns of ``docs`` but its text, with ``n_bytes, n_tokens, over_limit`` (more than ``limit`` tokens).

    ``cache`` is a Parquet table of ``digest, n_tokens`` by tokenizer version. Digests of the normalised contents are
    joined to it; texts it lacks are encoded once each and appended, then all counts are read from it. ``normalise``
    may fold texts that the tokenizer counts alike; byte-level vocabularies tell every byte apart, so it keeps them.

    A null text counts as empty (0 bytes, 0 tokens); repeated rows and texts each give a row; an empty table gives no
    rows; columns of ``docs`` that bear a name of the result are left out. A job lost on the way leaves the cache as
    it was or with whole entries more; entries written twice by jobs that ran at once are read as one.
    """
    spark = docs.sparkSession
    made = {"n_bytes", "n_tokens", "over_limit", "digest", "version"}
    keep = [c for c in docs.columns if c != text_col and c not in made]
    text = as_text(F.col(text_col))
    content = normalise(text)
    keyed = written(docs.select(*keep, text_bytes(text).alias("n_bytes"), digest(content).alias("digest")), "digests")
    distinct = keyed.select("digest").distinct()
    known = _cached(docs, cache, tokenizer.version)
    unseen = written(distinct if known is None else distinct.join(known, "digest", "left_anti"), "unseen")
    n_unseen = unseen.count()
    if n_unseen:
        texts = docs.select(digest(content).alias("digest"), content.alias("content"))
        few = n_unseen <= UNSEEN_BROADCAST
        if known is not None and few:
            texts = texts.join(F.broadcast(unseen), "digest", "left_semi")
        # copies meet inside each task first, so a text that fills the table is one row per task here
        texts = texts.groupBy("digest").agg(F.any_value("content").alias("content"))
        if known is not None and not few:
            texts = texts.join(unseen, "digest", "left_semi")
        counts = texts.mapInArrow(_encode(tokenizer), "digest binary, n_tokens long")
        counts.withColumn("version", F.lit(tokenizer.version)).write.mode("append").partitionBy("version").parquet(cache)
        known = _cached(docs, cache, tokenizer.version)
    if known is None:
        known = spark.createDataFrame([], "digest binary, n_tokens long")
    return spread_join(keyed, known, "digest").select(*keep, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
