import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from trawlnet.llm.mixing import Mix, exponent, mix_sources


def entropy(weights):
    return -sum(w * math.log(w) for w in weights)


def weights(shares, x):
    z = sum(p**x for p in shares)
    return [p**x / z for p in shares]


@pytest.mark.parametrize("evenness,most", [(0.9, 4.0), (0.99, 50.0), (0.5, 4.0), (1.0, 2.0), (1.0, 1e9)])
def test_exponent_meets_entropy_or_repetition(spark, evenness, most):
    shares = [0.5, 0.3, 0.15, 0.04, 0.01]
    df = spark.createDataFrame([(p, 1000.0) for p in shares], "p double, total double")
    x, z = exponent(df, Mix(evenness=evenness, most_copies=most))
    assert z == pytest.approx(sum(p**x for p in shares))
    target = evenness * math.log(5)

    def search(ok):
        low, high = 0.0, 1.0
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if ok(mid) else (low, mid)
        return low

    by_entropy = 1.0 if entropy(shares) >= target else search(lambda e: entropy(weights(shares, e)) >= target)
    by_copies = 1 - math.log(most) / math.log(50) if most < 50 else 0.0
    assert x == pytest.approx(max(by_entropy, by_copies), abs=1e-4)


def test_every_document_is_used_and_weights_are_met(spark):
    rows = [(i, "s0", 40 + i % 7) for i in range(900)] + [(1000 + i, "s1", 50) for i in range(90)] + [(2000 + i, None, 30) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n long").withColumn("text", F.lit("x"))
    spec = Mix(evenness=0.8, most_copies=5.0, block_tokens=2_000)
    got = mix_sources(df, spec, tokens=F.col("n")).collect()
    totals, sizes = Counter(), Counter()
    for _, s, n in rows:
        totals[s] += n
    for r in got:
        sizes[r["source"]] += r["tokens"]
    total = sum(totals.values())
    shares = [totals[s] / total for s in ("s0", "s1", None)]
    by_copies = 1 - math.log(5) / math.log(max(shares) / min(shares))
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if entropy(weights(shares, mid)) >= 0.8 * math.log(3) else (low, mid)
    want = weights(shares, max(low, by_copies))
    budget = max(t / w for t, w in zip((totals[s] for s in ("s0", "s1", None)), want, strict=True))
    for s, w in zip(("s0", "s1", None), want, strict=True):
        assert -1 <= sizes[s] - budget * w <= 50
    assert {r["doc_id"] for r in got} == {d for d, _, _ in rows}
    # a copy is complete before the next begins, and no document comes twice in one
    seen = Counter((r["doc_id"], r["copy"]) for r in got)
    assert set(seen.values()) == {1}
    blocks = defaultdict(list)
    for r in got:
        blocks[r["block"]].append(r)
    assert sorted(blocks) == list(range(len(blocks)))
    for own in blocks.values():
        assert sorted(r["position"] for r in own) == list(range(len(own)))
    for block in list(blocks)[1:-1]:
        assert sum(r["tokens"] for r in blocks[block]) == pytest.approx(2_000, abs=150)


def test_a_budget_cuts_each_source_at_its_weight(spark):
    rows = [(i, f"s{i % 2}", "a b c d") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mix_sources(df, Mix(budget=500, block_tokens=100)).collect()
    assert Counter(r["source"] for r in got) == {"s0": 50, "s1": 50}
    again = mix_sources(df.repartition(5), Mix(budget=500, block_tokens=100)).collect()
    assert sorted(got) == sorted(again)


def test_odd_cases(odd, odd_rows):
    got = mix_sources(odd)
    assert got.columns.count("position") == 1 and "score" in got.columns
    first = [r for r in got.collect() if r["copy"] == 0]
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in first) == Counter(odd_rows)


def test_empty_table(empty):
    assert mix_sources(empty).count() == 0
