import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from trawlnet.llm import token_counts
from trawlnet.llm.token_counts import Tokenizer, count_tokens
from trawlnet.session import scratch_path

HARD = ["", " ", "  a  b\n\n c ", "don't we'll I'M", "naïve café Ω≈ç √ 漢字 仮名 🙂🙃", "<|endoftext|>", "a<|endoftext|>b <|endoftext|>", "\r\n\t x y　z", "1234567 3.14e-10", "x" * 5000, "​﻿\x00\x07", "Á é", "٣٤٥ ⅷ ²", "'s 't 'S ’s", "a" + " " * 50 + "b", "#!$%&*()=[]{}|<>"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))


def test_fast_encoder_counts_as_the_library_does(tokenizer, documents, odd_rows):
    library = Library.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = HARD + [r["text"] for r in documents.collect()] + [r[1] for r in odd_rows if r[1]]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert tokenizer.counter()(texts) == want


def test_texts_that_the_fast_encoder_refuses_are_counted_by_the_library(tokenizer):
    library = Library.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["before", " " * 2_000_000, "a" + "\n" * 1_500_000 + "b <|endoftext|>", "after"]
    assert tokenizer.counter()(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"])
def test_other_files_use_their_library(name):
    count = Tokenizer(public_tokenizers.path(name)).counter()
    assert count([]) == [] and count(["some words", ""])[0] >= 2 and count([""]) == [0]


def test_unknown_kind_is_refused(tmp_path):
    with pytest.raises(ValueError):
        Tokenizer(str(tmp_path / "vocabulary.txt"))


def test_cache_is_used_and_only_misses_are_encoded(spark, tokenizer, odd, odd_rows, monkeypatch):
    cache = scratch_path(spark, "tokens")
    first = sorted(map(repr, count_tokens(odd, tokenizer, cache).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()))
    assert len(first) == len(odd_rows)
    stored = spark.read.parquet(cache)
    assert stored.count() == len({t or "" for _, t, _ in odd_rows}) == stored.select("digest").distinct().count()

    def refuse(_):
        raise AssertionError("a known text was encoded again")

    monkeypatch.setattr(token_counts, "_encode", refuse)
    again = count_tokens(odd, tokenizer, cache).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    assert sorted(map(repr, again)) == first
    monkeypatch.undo()
    more = odd.select("doc_id", "text").union(spark.createDataFrame([(99, "a text never seen")], "doc_id long, text string"))
    assert count_tokens(more, tokenizer, cache).count() == len(odd_rows) + 1
    assert spark.read.parquet(cache).count() == stored.count() + 1
    other = Tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    assert other.version != tokenizer.version
    count_tokens(more, other, cache).count()
    assert spark.read.parquet(cache).groupBy("version").count().count() == 2


def test_odd_cases(spark, tokenizer, odd):
    got = {}
    for r in count_tokens(odd, tokenizer, scratch_path(spark, "tokens")).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert [(r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got[30] + got[31]] == [(0, 0, False)] * 2
    assert len(got[40]) == 2 and len(got[None]) == 2 and got[50][0]["over_limit"]


def test_empty_table(spark, tokenizer, empty):
    cache = scratch_path(spark, "tokens")
    assert count_tokens(empty, tokenizer, cache).count() == 0
    assert count_tokens(empty, tokenizer, cache).columns == ["doc_id", "source", "lang", "n_chars", "n_bytes", "n_tokens", "over_limit"]
