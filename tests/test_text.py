import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trawlnet.functions import text as T
from trawlnet.functions.words import coded_words, drop_tags

SEPARATORS = ["\n", "\r", "\r\n", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", " ", " "]


def random_strings(n=3000, seed=3):
    rng = random.Random(seed)
    alphabet = SEPARATORS + ["a", "b", " ", "\t", "\x1f", " ", "　", "​", "é", "x y"]
    return ["".join(rng.choices(alphabet, k=rng.randrange(0, 9))) for _ in range(n)]


def evaluate(spark, values, expression, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r["out"] for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_split_lines_matches_python(spark):
    values = ["", "\n", "a", "a\n", "\n\n"] + [f"a{s}b" for s in SEPARATORS] + random_strings()
    assert evaluate(spark, values, T.split_lines) == [v.splitlines() for v in values]


def test_line_count_matches_python(spark):
    values = ["", "\n", "a\r\n"] + random_strings(seed=5)
    assert evaluate(spark, values, lambda c: T.n_lines(T.raw_lines(c))) == [len(v.splitlines()) for v in values]


def test_strip_and_blank_match_python(spark):
    values = ["", " \n\t", "\x1f", " \x1f a  "] + random_strings(seed=4)
    assert evaluate(spark, values, T.strip) == [v.strip() for v in values]
    assert evaluate(spark, values, T.is_non_blank) == [bool(v.strip()) for v in values]


def test_decode_replaces_bad_bytes(spark):
    rng = random.Random(1)
    values = [bytes.fromhex("FFFE6162C3287AE28278F09F92"), b"", "é ".encode()]
    values += [bytes(rng.choices([0x61, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0xFF, 0x80], k=rng.randrange(9))) for _ in range(2000)]
    assert evaluate(spark, values, T.decode_utf8, "binary") == [v.decode("utf-8", errors="replace") for v in values]


@pytest.mark.parametrize(
    "name,expected",
    [
        ("a.py", True), ("C.PY", True), ("a..py", True), ("__init__.py", True), (".b.py", True), ("x.d.ts", True),
        (".py", False), ("..py", False), ("a", False), ("a.", False), ("a.py.txt", False), ("x.tsx", False), ("a.py\n", False), ("...py", False), ("x\ny.py", True),
    ],
)
def test_extension(spark, name, expected):
    assert evaluate(spark, [name], lambda c: T.has_extension(c, (".py", ".md", ".ts", ".js"))) == [expected]


def test_words():
    rows, codes, words = coded_words(pa.array(["Ab, c_d É9!", "", "--", None, " ab"]))
    assert [(r, words[c]) for r, c in zip(rows.tolist(), codes.tolist())] == [(0, "ab"), (0, "c"), (0, "d"), (0, "é9"), (4, "ab")]
    assert [len(x) for x in coded_words(pa.array([], pa.string()))] == [0, 0, 0]
    assert drop_tags(pa.array(["<a\nb>x<c>", None])).to_pylist() == [" x ", None]


def test_first_non_empty(spark):
    assert evaluate(spark, ["x", "", None], lambda c: T.first_non_empty(c, "other")) == ["x", "other", "other"]


def test_batches_are_cut_into_words_a_few_bytes_at_a_time(monkeypatch):
    from trawlnet.functions import words as W
    from trawlnet.operators import embed as E
    from trawlnet.operators import search as S

    texts = pa.array(["one two", None, "", "three " * 50, "four", "five six", None])
    assert [(s.start, s.stop) for s in W.text_slices(texts, 10)] == [(0, 3), (3, 4), (4, 5), (5, 7)]
    assert list(W.text_slices(texts[:0])) == []
    whole = E.hash_vectors(texts, 8)
    seen = []
    for module in (W, E):
        monkeypatch.setattr(module, "SLICE_BYTES", 10)
    for module in (E, S):
        monkeypatch.setattr(module, "coded_words", lambda t: seen.append(len(t)) or coded_words(t))
    assert (E.hash_vectors(texts, 8) == whole).all() and E.hash_vectors(texts[:0], 8).shape == (0, 8)
    assert seen == [3, 1, 1, 2]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), texts], names=["page_id", "_html"])
    posted = [r for b in S._post("page_id")([batch]) for r in zip(*[c.to_pylist() for c in b.columns])]
    assert seen[4:] == [3, 1, 1, 2] and ("three", 3, 50) in posted and len(posted) == 6
