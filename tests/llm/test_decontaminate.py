import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import prose
from trawlnet.llm import decontaminate
from trawlnet.llm.decontaminate import Contamination, build_index, contaminated


def words(text):
    return re.findall(r"[^\x00-/:-@\[-`{-\x7f]+", (text or "").lower())


def bag(ws, k):
    return Counter(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))


def brute(docs, items, k=5, percent=80):
    """(doc_id, item_id) of every item with a similar window, all windows compared."""
    kept = {}
    for i, t in items:
        if words(t):
            kept.setdefault(tuple(words(t)), set()).add(i)
    weigh = lambda s: sum(len(w.encode()) for w in s)
    out = set()
    for d, t in docs:
        ws = words(t)
        grams = {n: set(bag(ws, n)) for n in range(1, k + 1)}
        for item, ids in kept.items():
            kk = min(k, len(item))
            own = bag(item, kk)
            if grams[kk].isdisjoint(own):
                continue
            n = min(len(item), len(ws))
            for at in range(len(ws) - n + 1) if n >= kk else ():
                seen = bag(ws[at : at + n], kk)
                both = sum(min(c, seen[s]) * weigh(s) for s, c in own.items())
                every = sum(c * weigh(s) for s, c in own.items()) + sum(c * weigh(s) for s, c in seen.items()) - both
                if 100 * both >= percent * every:
                    out |= {(d, i) for i in ids}
                    break
    return out


@pytest.fixture(scope="module")
def items():
    base = prose(900, 40)
    return [(i, prose(800 + i, 15 + 4 * i)) for i in range(8)] + [(20, base), (21, base), (22, base.upper() + "!"), (23, "short item"), (24, ""), (25, None), (None, prose(5, 20))]


@pytest.fixture(scope="module")
def leaky(items, odd_rows):
    rows = [(d, t) for d, t, _ in odd_rows]
    long = items[7][1].split()
    edited = list(long)
    edited[20] = "changed"
    rows += [
        (70, "before it " + items[3][1] + " and after"), (71, items[20 - 12][1].upper().replace(" ", "!! ")), (72, " ".join(edited)),
        (73, " ".join(long[:-3])), (74, prose(1, 30) + " " + " ".join(long[:20])), (75, f"{items[2][1]} {prose(2, 40)} {items[2][1]}"), (76, "a Short, ITEM."), (77, "other short things"),
    ]
    return rows


def test_matches_equal_brute_force(spark, items, leaky):
    docs = spark.createDataFrame(leaky, "doc_id long, text string").repartition(3)
    got = contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == brute(leaky, items)
    assert len([r for r in got if r["doc_id"] == 75]) == 2
    hit = next(r for r in got if r["doc_id"] == 70)
    assert (hit["first_word"], hit["n_words"], hit["similarity"]) == (2, 27, 1.0)


def test_blocks_of_the_benchmark_give_the_same(spark, items, leaky, monkeypatch):
    docs, bench = spark.createDataFrame(leaky, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 700)
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, bench).collect()}
    assert got == brute(leaky, items)


def test_blocks_find_every_fingerprint_within_the_radius():
    spec = Contamination()
    index = build_index([(i, prose(i, 30)) for i in range(60)], spec)
    rng = np.random.default_rng(1)
    for i in range(60):
        bits = np.unpackbits(index.prints[i])
        bits[rng.choice(128, spec.radius, replace=False)] ^= 1
        rows, found = index.near(np.packbits(bits)[None, :], 30)
        assert i in found and not rows.any()


def test_every_id_of_an_item_has_its_row(spark, items):
    docs = spark.createDataFrame([(1, prose(900, 40)), (2, prose(5, 20))], "doc_id long, text string")
    got = contaminated(docs, spark.createDataFrame([*items, (21, prose(900, 40))], "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"] or -1) for r in got) == [(1, 20), (1, 21), (1, 22), (2, -1)]


def test_a_long_item_in_a_longer_text(spark):
    item = prose(77, 4_000)
    text = " ".join([prose(78, 4_000), item, prose(79, 4_000)])
    index = build_index([(5, item), (6, prose(80, 4_000))], Contamination())
    start = time.process_time()
    rows, found = decontaminate._hits(index, pa.array([text]))
    took = time.process_time() - start
    (hit,) = found
    assert hit[1:] == (4_000, 4_000, 0) and hit[0] == 1.0 and rows == [0]
    assert took < 20  # a quadratic search took minutes


def test_a_repetitive_text_and_item():
    item = " ".join(["again and again it says the same"] * 30)
    index = build_index([(1, item)], Contamination())
    rows, found = decontaminate._hits(index, pa.array([item, item + " " + item, "again and again it says the same"]))
    assert [(r, h[1], h[0]) for r, h in zip(rows, found, strict=True)] == [(0, 0, 1.0), (1, 0, 1.0), (1, 210, 1.0)]


def test_benchmark_of_the_given_tables(spark, tiny, documents):
    bench = spark.read.parquet(f"{tiny}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(documents, bench).collect()}
    assert got == brute([(r["doc_id"], r["text"]) for r in documents.collect()], [tuple(r) for r in bench.select("item_id", "text").collect()])


def test_empty_tables(spark, empty, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(documents, none).count() == 0
    assert contaminated(empty, spark.createDataFrame([(1, prose(1, 20))], "item_id long, text string")).count() == 0


def test_clashing_columns(odd, spark):
    assert contaminated(odd, spark.createDataFrame([(1, prose(100, 60))], "item_id long, text string")).columns[:2] == ["doc_id", "item_id"]
