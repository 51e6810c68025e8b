import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer as Library

from trawlnet.llm.packing import Packing, differencing, fill, pack
from trawlnet.llm.segments import WordEnds, _ends_alone
from trawlnet.llm.token_counts import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "Hello  WORLD\n\tit's 3.14!", "a<|endoftext|>b <|startoftext|> x", "<|ENDOFTEXT|>", "é ́x", "ΑΣ Σ", "İstanbul ǅ",
    " a b　c\x1cd\x85e", "中文 测试。", "don't've'll 'S", "x" * 3000, "🙂 a‍b", "\x00 a\x00b", " ".join(["The quick"] * 500),
]


RUNS = "end. (x) Word&&& a_b A-B ... x!? [y] {z} #tag @me don't. it's! a<b <| |> <|endoftext|>. x1. 1.5, `q` ^~ = ==> X.Y 'a' ß. Éa! a<|endoftext|>"
ODD.append(RUNS)


def ids_of(texts):
    library = Library.from_file(PATH)
    return [library.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("windows", [1, 2, 3, 7])
def test_differencing_puts_every_size_once_and_evenly(windows):
    rng = np.random.default_rng(windows)
    sizes = rng.integers(1, 50, 60)
    window = differencing(sizes, windows)
    sums = np.bincount(window, weights=sizes, minlength=windows)
    assert sums.sum() == sizes.sum() and len(sums) == windows
    assert sums.max() - sums.min() <= 4


def test_differencing_by_hand():
    # two ways: 8, 7, 6, 5, 4 leave differences 1, 1, 4 and end two apart
    sums = np.bincount(differencing(np.array([8, 7, 6, 5, 4]), 2), weights=[8, 7, 6, 5, 4])
    assert sorted(sums) == [14, 16]


def test_windows_rise_until_all_fit():
    window = fill(np.array([7, 7, 7, 1]), 10)
    assert np.bincount(window, weights=[7, 7, 7, 1]).max() <= 10
    assert list(fill(np.array([10]), 10)) == [0]
    assert list(differencing(np.zeros(0, np.int64), 3)) == []


def test_ids_equal_the_library():
    encoder = WordEnds(Tokenizer(PATH).data)
    assert encoder.cut
    ids, counts = encoder(pa.array([*ODD, None]))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == ids_of([*ODD, None])


def check(rows, docs, spec):
    """Pieces of the sorted documents ``(doc_id, ids)`` make them whole again, once each; returns the sequences."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False))
        assert sum(n for _, n in parts) <= spec.capacity
    wanted = Counter()
    starts = defaultdict(Counter)
    for r in rows:
        starts[(r["doc_id"], r["doc_tokens"])][(r["start"], r["length"], r["ids_crc32"])] += 1
    for doc_id, ids in docs:
        wanted[(doc_id, len(ids))] += len(ids)
    assert {k: sum(n * c for (_, n, _), c in p.items()) for k, p in starts.items()} == dict(wanted)
    for doc_id, ids in docs:
        raw = np.array(ids, "<u4").tobytes()
        at = 0
        own = starts[(doc_id, len(ids))]
        while at < len(ids):
            piece = next(p for p in sorted(own) if p[0] == at and own[p] and p[2] == zlib.crc32(raw[4 * at : 4 * (at + p[1])]))
            own[piece] -= 1
            at += piece[1]
        assert at == len(ids)
    assert not any(sum(p.values()) for p in starts.values())
    return sequences


SMALL = Packing(capacity=64, most_piece=16, windows=8, spare=2, cell_tokens=3_000)


@pytest.mark.parametrize("spec", [SMALL, Packing()])
def test_every_id_is_in_one_piece(spark, odd, odd_rows, spec):
    rows = [(i, t) for i, t, _ in odd_rows] + [(1000 + i, t) for i, t in enumerate(ODD)]
    extra = spark.createDataFrame([(1000 + i, t, None) for i, t in enumerate(ODD)], "doc_id long, text string, source string")
    df = odd.unionByName(extra, allowMissingColumns=True).selectExpr("*", "1 as ids", "2 as row", "3 as cell", "4 as sequence_id")
    got = pack(df, Tokenizer(PATH), spec).collect()
    docs = [(i, [*ids, 1]) for (i, _), ids in zip(rows, ids_of([t for _, t in rows]), strict=True)]
    sequences = check(got, docs, spec)
    total = sum(len(d) for _, d in docs)
    assert len(sequences) <= -(-total // spec.capacity) * (1.06 if spec is SMALL else 1) + total // spec.cell_tokens + 1


def test_empty_table(spark, empty):
    assert pack(empty, Tokenizer(PATH)).collect() == []


def test_little_padding_on_the_small_table(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").unionAll(spark.read.parquet(f"{tiny.replace('0.001', '0.01')}/documents.parquet"))
    got = pack(docs, Tokenizer(PATH)).collect()
    used = sum(r["length"] for r in got)
    sums = Counter()
    for r in got:
        sums[r["sequence_id"]] += r["length"]
    room = sum(n if n & (n - 1) == 0 else 2048 for n in sums.values())
    assert used / room > 0.985


def test_plain_words_equal_the_library_and_need_no_memory():
    # every entry of the vocabulary that is a word of its own, and words that it lacks, in any case and with any signs
    rng = np.random.default_rng(5)
    signs = [*"abcdefghijklmnopqrstuvwxyzABCXYZ0123456789'''.,!?&-_()[]{}#@~`^=+*/|:;\"%$\\>", *"éèñçêüäößíÉÈÑÇÄÖÜÓÊÍÀÞþÿøØ×÷µªº", "'s", "'ll", "'RE", "é"]
    words = ["".join(rng.choice(signs, rng.integers(1, 14))) for _ in range(20_000)]
    words += [w.decode() for w in (b"x" * 255, b"x" * 257, b"'", b"''s", b"'sxyz's", b"don't've'llx", b"'d'D", b"1'2'ts")]
    vocabulary = Library.from_file(PATH)
    words += [w for i in range(0, 49_000, 7) if (w := vocabulary.id_to_token(i).removesuffix("</w>")).isascii() and "<" not in w]
    texts = [" ".join(words[i : i + 50]) for i in range(0, len(words), 50)]
    encoder = WordEnds(Tokenizer(PATH).data)
    ids, counts = encoder(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == ids_of(texts)
    plain = WordEnds(Tokenizer(PATH).data)
    plain(pa.array([" ".join(f"w{i}ord Émile'{i}" for i in range(2_000))]))
    assert not plain.library.known


def test_vocabularies_whose_joins_differ_by_merges_are_refused():
    # "bc" joins before "ab", so only a listed pair ("ab", "c") would ever make "abc", and text alone cannot tell
    assert _ends_alone({"b": 0, "bc": 1, "ab": 2, "abc": 3}, {"bc": ("b", "c"), "ab": ("a", "b"), "abc": ("a", "bc")})
    assert not _ends_alone({"b": 0, "bc": 1, "ab": 2, "abc": 3}, {"bc": ("b", "c"), "ab": ("a", "b"), "abc": ("ab", "c")})


def test_differencing_of_many_small_sizes_holds_little():
    sizes = np.ones(6_000, np.int64)
    tracemalloc.start()
    window = differencing(sizes, 128)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1_000 * len(sizes)
    assert np.ptp(np.bincount(window, minlength=128)) <= 1
