import json
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from trawlnet.operators import search as S

NONE = "No results found."


def format_one(spark, payload, fn):
    df = spark.createDataFrame([(payload if payload is None or isinstance(payload, str) else json.dumps(payload),)], "p string")
    return df.select(fn(F.col("p"))).first()[0]


HIT = {"title": "T", "url": "U", "content": "C"}


@pytest.mark.parametrize(
    "payload,expected",
    [
        ({"results": [HIT, {"title": "T2"}]}, "- T: U\n  C\n- T2: \n  "),
        ({"results": [{"title": None, "url": "U", "extra": 1}]}, "- : U\n  "),
        ({"results": [], "answer": "A"}, "A"),
        ({"answer": ""}, NONE),
        ({"results": None}, NONE),
        ({}, NONE),
    ],
)
def test_format_a(spark, payload, expected):
    assert format_one(spark, payload, S.format_response_a) == expected


def test_format_b_keeps_five(spark):
    hits = [{"title": f"t{i}", "link": "l", "snippet": "s"} for i in range(7)]
    assert format_one(spark, {"organic": hits}, S.format_response_b) == "\n".join(f"- t{i}: l\n  s" for i in range(5))
    assert format_one(spark, {"organic": []}, S.format_response_b) == NONE
    assert format_one(spark, {}, S.format_response_b) == NONE


@pytest.mark.parametrize(
    "row,expected",
    [
        (('{"answer":"A"}', None, '{"organic":[]}', None), "A"),
        ((None, "boom", '{"organic":[]}', None), "Tavily search failed: boom"),
        ((None, None, '{"organic":[]}', None), NONE),
        ((None, None, None, "boom"), "Serper search failed: boom"),
        ((None, None, None, None), S.NO_PROVIDER),
        (("{broken", None, '{"organic":[]}', None), "Tavily search failed: malformed response"),
        ((None, None, "", None), "Serper search failed: malformed response"),
    ],
)
def test_precedence(spark, row, expected):
    df = spark.createDataFrame([row], "a string, ea string, b string, eb string")
    assert df.select(S.search_text(*[F.col(c) for c in df.columns])).first()[0] == expected


def words(s):
    return re.findall(r"[^\W_]+", s.lower())


def brute_force(pages, queries, k):
    bags = {p: Counter(words(re.sub(r"<[^>]*>", " ", h))) for p, h in pages}
    df = Counter(w for bag in bags.values() for w in bag)
    out = []
    for q, text in queries:
        scores = []
        for p, bag in bags.items():
            score = round(sum(bag[w] * math.log(len(bags) / df[w]) for w in sorted(set(words(text))) if w in bag), 6)
            if score > 0:
                scores.append((-score, p))
        out += [(q, rank, p, -s) for rank, (s, p) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("max_queries", [S.BROADCAST_ROWS, 3])
def test_page_search_matches_brute_force(spark, tiny, max_queries, monkeypatch):
    monkeypatch.setattr(S, "_SLICE_CELLS", 500)
    pages = spark.read.parquet(f"{tiny}/pages.parquet")
    queries = spark.read.parquet(f"{tiny}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text").where("item_id < 12")
    odd = spark.createDataFrame([(100, ""), (101, "zzzzzz"), (102, None)], "query_id long, text string")
    queries = queries.unionByName(odd)
    got = S.search_pages(pages, queries, 4, max_queries=max_queries).collect()
    expected = brute_force(
        [(r["page_id"], r["html"]) for r in pages.collect()], [(r[0], r[1] or "") for r in queries.collect()], 4
    )
    assert sorted((r["query_id"], r["rank"], r["page_id"], round(r["score"], 5)) for r in got) == [
        (q, rank, p, round(s, 5)) for q, rank, p, s in expected
    ]


def test_pages_are_cut_into_words_once_for_any_number_of_queries(spark):
    seen = spark.sparkContext.accumulator(0)
    rng = random.Random(3)
    # "the" is on nearly all pages, and many times on a few
    texts = [" ".join(rng.choice("abcdefghijkl") * 2 for _ in range(20)) + " the" * (rng.randrange(9) if i % 7 else 0) for i in range(120)]
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id long, html string").repartition(3)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    index = S.index_pages(pages.mapInArrow(count, pages.schema).repartition(4))
    indexed = seen.value
    queries = [(i, " ".join(rng.choice("abcdefghijklmn") * 2 for _ in range(3)) + " the") for i in range(60)] + [(7, "aa bb"), (100, "the"), (None, "cc")]
    df = spark.createDataFrame(queries, "query_id long, text string")
    got = S.search_index(index, df, 3).collect()
    merged = {}
    for q, t in queries:
        merged[q] = merged.get(q, "") + " " + t
    wanted = brute_force(list(enumerate(texts)), [(-1 if q is None else q, t) for q, t in merged.items()], 3)
    assert sorted((-1 if r["query_id"] is None else r["query_id"], r["rank"], r["page_id"], round(r["score"], 5)) for r in got) == [
        (q, rank, p, round(s, 5)) for q, rank, p, s in wanted
    ]
    S.search_index(index, df, 2).collect()
    assert seen.value == indexed
    for bound in (3, 8192):  # both ways take rows of one id as one query
        both = S.search_pages(pages, df, 3, max_queries=bound).collect()
        assert sorted((r["query_id"] or -1, r["rank"], r["page_id"]) for r in both) == sorted((r["query_id"] or -1, r["rank"], r["page_id"]) for r in got)


def test_frequent_words_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(S, "SLICE_ROWS", 10)
    pages = spark.createDataFrame([(i, f"common w{i % 5} " + "common " * (i % 3) + ("" if i else "x")) for i in range(49)] + [(99, "other")], "page_id long, html string")
    queries = spark.createDataFrame([(1, "common w1"), (2, "common"), (3, "other x")], "query_id long, text string")
    got = S.search_index(S.index_pages(pages), queries, 4).collect()
    wanted = brute_force([(r[0], r[1]) for r in pages.collect()], [tuple(r) for r in queries.collect()], 4)
    assert sorted((r["query_id"], r["rank"], r["page_id"], round(r["score"], 5)) for r in got) == [(q, n, p, round(s, 5)) for q, n, p, s in wanted]


def test_page_search_moves_no_pages(spark, tiny, plan):
    pages = spark.read.parquet(f"{tiny}/pages.parquet")
    queries = spark.read.parquet(f"{tiny}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text")
    text = plan(S.search_pages(pages, queries))
    assert text.count("Exchange hashpartitioning") == 1 and "WindowGroupLimit" in text
    assert "NestedLoopJoin" not in text
