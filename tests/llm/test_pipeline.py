from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as P
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_near_dup import brute as groups
from trawlnet.llm.quality_cnn import Shape, learn, probabilities
from trawlnet.llm.ring import Ring


@pytest.fixture(scope="module")
def folder(spark, tiny, odd_rows, tmp_path_factory):
    """The small tables with the odd rows added, and columns whose names the operators use themselves."""
    place = tmp_path_factory.mktemp("sf")
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text", "source")
    more = spark.createDataFrame([(None if d is None else 10_000 + d, t, s) for d, t, s in odd_rows], docs.schema)
    every = docs.union(more).selectExpr("*", "doc_id as score", "'x' as tokens", "1 as copy", "2 as block", "3 as shard", "'y' as `group`")
    every.repartition(3).write.parquet(f"{place}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{tiny}/{name}.parquet").write.parquet(f"{place}/{name}.parquet")
    return str(place)


def rows(df):
    return Counter((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_stages_equal_their_brute_force_versions(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    columns = docs.columns

    params = learn(docs.select("doc_id", "text"), labels.select("doc_id", "quality"))
    texts = [(t or "").encode() for _, t in rows(docs)]
    scores = probabilities(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts]), params, Shape())
    want = Counter({k: n for (k, n), s in zip(rows(docs).items(), scores, strict=True) if s >= P.LEAST_QUALITY})
    good = P.quality(spark, docs, folder)
    assert good.columns == columns and rows(good) == want

    # near-duplicates, leaks and the mix are held against all rows, so that no odd case is gone before
    single = P.near_dups(spark, docs, folder)
    every = list(rows(docs).elements())
    firsts = Counter(k for k in every if not (k[1] or "").split())
    assert single.columns == columns
    got = rows(single)
    assert Counter({k: n for k, n in got.items() if not (k[1] or "").split()}) == firsts
    kept = Counter(component_of(every)[k] for k in got if (k[1] or "").split())
    assert set(kept.values()) == {1} and len(kept) == len({component_of(every)[k] for k in every if (k[1] or "").split()})
    assert all(n == 1 for k, n in got.items() if (k[1] or "").split())

    clean = P.decontamination(spark, docs, folder)
    leaking = {d for d, _ in leaks(enumerate_texts(every), bench)}
    assert clean.columns == columns
    assert rows(clean) == Counter(k for i, k in enumerate(every) if i not in leaking)

    mixed = P.mixing(spark, docs, folder)
    assert mixed.columns == columns and set(rows(mixed)) == set(rows(docs))
    assert all(rows(mixed)[k] >= n for k, n in rows(docs).items())

    shards = P.sharding(spark, docs, folder).groupBy("shard").count().collect()
    assert len(shards) == Ring().shards and max(r["count"] for r in shards) - min(r["count"] for r in shards) <= 1


def enumerate_texts(every):
    return [(i, t) for i, (_, t) in enumerate(every)]


_CACHE = {}


def component_of(every):
    """The lowest position of each row's component."""
    key = id(every)
    if key not in _CACHE:
        found = groups(enumerate_texts(every), 5)
        _CACHE[key] = {every[i]: low for i, _, low in found}
    return _CACHE[key]


def test_run_chains_the_stages(spark, folder):
    docs, stages = spark.read.parquet(f"{folder}/documents.parquet"), P.STAGES
    for _, stage in stages[:-2]:
        docs = stage(spark, docs, folder)
    got = {r["doc_id"] for r in P.run(spark, folder).collect()}
    assert got == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_empty_documents(spark, folder, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
