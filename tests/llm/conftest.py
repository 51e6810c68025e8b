"""Small tables with every odd case: nulls, empty and long texts, repeated rows, clashing column names."""

import random

import pytest

WORDS = "river stone lamp orange quiet market seven window paper cloud bright engine garden letter winter silver".split()

CLASHES = ("score", "digest", "n_tokens", "tokens", "copy", "block", "position", "shard", "slot", "at", "cell", "group", "node", "hub", "key", "set_id", "blob", "version", "kept", "similarity", "start", "end", "at_", "n_words")


def prose(seed, n, vocabulary=None):
    rng = random.Random(seed)
    vocabulary = vocabulary or [a + b for a in WORDS for b in WORDS]
    return " ".join(rng.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, source) with nulls, blanks, ties and repeats."""
    base = prose(1, 120)
    rows = [(i, prose(100 + i, 60 + i), f"s{i % 3}") for i in range(12)]
    rows += [
        (20, base, "s0"), (21, base, "s0"), (22, base.upper(), None), (23, base + " tail", "s1"),
        (30, None, "s0"), (31, "", "s1"), (32, " \t\n ", "s2"), (33, "one", None),
        (40, prose(7, 80), "s0"), (40, prose(7, 80), "s0"), (41, prose(8, 70), "s1"), (41, prose(9, 70), "s1"),
        (None, prose(10, 50), "s2"), (None, None, None), (50, prose(11, 3_000), "s2"),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    df = spark.createDataFrame(odd_rows, "doc_id long, text string, source string")
    return df.selectExpr("*", *[f"'x' as {c}" for c in CLASHES]).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string, n_chars long")


@pytest.fixture(scope="session")
def documents(spark, tiny):
    return spark.read.parquet(f"{tiny}/documents.parquet")
