import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawlnet.operators import retrieve as R


def frame(spark, vectors, key, scope=None, first=0):
    rows = [(first + i, [float(x) for x in v], (i % 3 if scope else 0)) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"{key} long, embedding array<float>, scope int").repartition(4)


def brute_force(q, x, k, same_scope=False):
    q, x = (np.asarray(m, dtype="float32").astype("float64") for m in (q, x))
    out = []
    for i, v in enumerate(q):
        d = np.round(((x - v) ** 2).sum(axis=1), 6)
        candidates = [(float(d[j]), j) for j in range(len(x)) if not same_scope or j % 3 == i % 3]
        for rank, (cost, j) in enumerate(sorted(candidates)[:k], 1):
            out.append((i, rank, j, cost))
    return sorted(out)


def rows(hits):
    return sorted((r["query_id"], r["rank"], r["id"], r["distance"]) for r in hits.collect())


def skewed_vectors(n, seed, dim=6):
    """A third of the rows are one and the same vector, a third sit close to it, the rest spread out."""
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim))
    v[: n // 3] = v[0]
    v[n // 3 : 2 * n // 3] = v[0] + rng.normal(scale=0.05, size=(2 * n // 3 - n // 3, dim))
    return v


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(R, "ITEM_BLOCK", 40)
    monkeypatch.setattr(R, "QUERY_BLOCK", 25)


@pytest.mark.parametrize("bound", [R.BROADCAST_ROWS, 10])
@pytest.mark.parametrize("k", [1, 5, 60])
def test_exact_on_skewed_data(spark, small_blocks, bound, k):
    x, q = skewed_vectors(400, 1), skewed_vectors(90, 2)
    q[:40] = x[:40]
    got = R.knn(frame(spark, q, "query_id"), frame(spark, x, "id"), k, broadcast_rows=bound)
    assert rows(got) == brute_force(q, x, k)


@pytest.mark.parametrize("bound", [R.BROADCAST_ROWS, 10])
def test_scope_limits_candidates(spark, small_blocks, bound):
    x, q = skewed_vectors(200, 3), skewed_vectors(50, 4)
    got = R.knn(frame(spark, q, "query_id", True), frame(spark, x, "id", True), 7, scope="scope", broadcast_rows=bound)
    assert rows(got) == brute_force(q, x, 7, same_scope=True)


@pytest.mark.parametrize("bound", [R.BROADCAST_ROWS, 1])
def test_fewer_items_than_k_and_none_at_all(spark, bound):
    q = frame(spark, [[0, 0], [1, 1], [2, 2]], "query_id")
    x = frame(spark, [[0, 1], [1, 0]], "id")
    assert rows(R.knn(q, x, 5, broadcast_rows=bound)) == brute_force([[0, 0], [1, 1], [2, 2]], [[0, 1], [1, 0]], 5)
    assert rows(R.knn(q, x.limit(0), 5, broadcast_rows=bound)) == []


@pytest.mark.parametrize("scope", [None, "scope"])
@pytest.mark.parametrize("grid_bytes", [400, 4_000, 64 << 20])
def test_grids_of_any_size_give_the_same(spark, monkeypatch, scope, grid_bytes):
    monkeypatch.setattr(R, "GRID_BYTES", grid_bytes)
    monkeypatch.setattr(R, "_CELL_ITEMS", 7)
    x, q = skewed_vectors(150, 5), skewed_vectors(61, 6)
    got = R.knn(frame(spark, q, "query_id", scope), frame(spark, x, "id", scope), 4, scope=scope, broadcast_rows=6)
    assert rows(got) == brute_force(q, x, 4, same_scope=bool(scope))


def test_ten_query_blocks_scan_the_items_once(spark, tmp_path):
    x, q = skewed_vectors(120, 7), skewed_vectors(100, 8)
    frame(spark, x, "id").write.parquet(str(tmp_path / "items"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    stored = spark.read.parquet(str(tmp_path / "items"))
    items = stored.mapInArrow(count, stored.schema)
    hits = R.knn(frame(spark, q, "query_id"), items, 3, broadcast_rows=10)
    assert seen.value == 0  # nothing is read, cut or counted beforehand
    assert rows(hits) == brute_force(q, x, 3)
    assert seen.value == 120


def test_scopes_that_no_query_asks_are_not_shuffled(spark, tmp_path, plan):
    x, q = skewed_vectors(90, 9), skewed_vectors(60, 10)
    frame(spark, x, "id", True).write.partitionBy("scope").parquet(str(tmp_path / "items"))
    asked = frame(spark, q, "query_id", True).where("scope = 1")
    hits = R.knn(asked, spark.read.parquet(str(tmp_path / "items")), 3, scope="scope", broadcast_rows=5)
    assert rows(hits) == [r for r in brute_force(q, x, 3, same_scope=True) if r[0] % 3 == 1]
    assert "PartitionFilters: []" not in plan(hits)


def test_bad_arguments(spark):
    x = frame(spark, [[0, 1]], "id")
    with pytest.raises(ValueError):
        R.knn(frame(spark, [[0, 1]], "query_id"), x, 0)
    with pytest.raises(Exception):
        R.knn(frame(spark, [[0, 1, 2]], "query_id"), x).collect()


def test_distances_do_not_fall_with_rank(spark, tiny):
    v = spark.read.parquet(f"{tiny}/embeddings.parquet")
    hits = R.knn(v.withColumnRenamed("vec_id", "query_id"), v.withColumnRenamed("vec_id", "id"), 8).collect()
    by_query = {}
    for r in sorted(hits, key=lambda r: (r["query_id"], r["rank"])):
        by_query.setdefault(r["query_id"], []).append(r["distance"])
    assert len(by_query) == v.count()
    assert all(d == sorted(d) and len(d) == 8 and d[0] == 0.0 for d in by_query.values())


def test_plan_limits_groups_before_the_shuffle_and_pairs_nothing(spark, tiny, plan):
    v = spark.read.parquet(f"{tiny}/embeddings.parquet")
    text = plan(R.knn(v.withColumnRenamed("vec_id", "query_id"), v.withColumnRenamed("vec_id", "id"), 5))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "NestedLoopJoin" not in text and "CartesianProduct" not in text


def test_null_and_nan_elements_are_refused_on_both_sides(spark):
    good = frame(spark, [[0, 1], [1, 0]], "id")
    for bad in ([float("nan"), 1.0], [None, 1.0], [float("inf"), 0.0]):
        odd = spark.createDataFrame([(1, bad)], "id long, embedding array<float>")
        for bound in (R.BROADCAST_ROWS, 1):
            with pytest.raises(Exception, match="null, NaN or infinite"):
                R.knn(good.withColumnRenamed("id", "query_id"), odd, broadcast_rows=bound).collect()
            with pytest.raises(Exception, match="null, NaN or infinite"):
                R.knn(odd.withColumnRenamed("id", "query_id"), good, broadcast_rows=bound).collect()


def test_far_from_the_origin(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4)) + 1e7
    q = x[:40] + rng.normal(scale=0.1, size=(40, 4))
    columns = "long, embedding array<double>"
    qs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], f"query_id {columns}")
    xs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"id {columns}")
    for bound in (R.BROADCAST_ROWS, 10):
        got = {(r["query_id"], r["id"]) for r in R.knn(qs, xs, 3, broadcast_rows=bound).collect()}
        assert got == {(i, int(j)) for i, v in enumerate(q) for j in np.argsort(((x - v) ** 2).sum(axis=1))[:3]}


def test_k_beyond_the_group_limit(spark):
    x, q = skewed_vectors(1700, 6, dim=2), skewed_vectors(6, 7, dim=2)
    got = R.knn(frame(spark, q, "query_id"), frame(spark, x, "id"), 1500, broadcast_rows=2)
    assert rows(got) == brute_force(q, x, 1500)


def test_embedder_that_never_repeats_itself(spark):
    """Every query is answered, and each is embedded once."""
    q = frame(spark, skewed_vectors(60, 8), "query_id")
    q = q.withColumn("embedding", F.transform("embedding", lambda v: (v + F.rand() * 1e-6).cast("float")))
    for bound in (R.BROADCAST_ROWS, 7):
        hits = R.knn(q, frame(spark, skewed_vectors(100, 9), "id"), 4, broadcast_rows=bound)
        assert hits.groupBy("query_id").count().where("count = 4").count() == 60


@pytest.mark.parametrize("bound", [R.BROADCAST_ROWS, 3])
def test_one_query_in_two_scopes_is_ranked_in_each(spark, bound):
    x = frame(spark, skewed_vectors(90, 10), "id", True)
    q = frame(spark, skewed_vectors(8, 11), "query_id", True)
    q = q.union(q.withColumn("scope", (F.col("scope") + 1) % 3))
    got = R.knn(q, x, 5, scope="scope", broadcast_rows=bound)
    counts = got.groupBy("query_id", "scope").agg(F.count("*").alias("n"), F.max("rank").alias("last")).collect()
    assert len(counts) == 16 and all((r["n"], r["last"]) == (5, 5) for r in counts)


def test_approximate_recall(spark, tiny, small_blocks):
    v = spark.read.parquet(f"{tiny}/embeddings.parquet")
    q, x = v.withColumnRenamed("vec_id", "query_id"), v.withColumnRenamed("vec_id", "id")
    found = R.knn_approximate(q, x, 5)
    truth = R.knn(q, x, 5)
    assert R.recall(found, truth).first()["recall"] >= 0.9
    exact = {(a, c): d for a, _, c, d in rows(R.knn(q, x, 500))}
    assert all(exact[a, c] == d for a, _, c, d in rows(found))


def test_format_hits(spark):
    df = spark.createDataFrame(
        [(1, ["a", None, "", "b"]), (2, ["", None]), (3, []), (4, None)], "i int, d array<string>"
    )
    got = {r["i"]: r["t"] for r in df.select("i", R.format_hits(F.col("d")).alias("t")).collect()}
    none = "No results found."
    assert got == {1: "a\n\n---\n\nb", 2: none, 3: none, 4: none}


def test_nested_hits_and_attachments(spark):
    hits = spark.createDataFrame([(1, 2, "b", 0.5), (1, 1, "a", 0.1)], "query_id int, rank int, document string, distance double")
    nested = R.nest_hits(hits, fields=("rank", "document")).first()
    assert [tuple(h) for h in nested["hits"]] == [(1, "a"), (2, "b")]
    attached = spark.createDataFrame([(1, 1, "note")], "query_id int, rank int, document string")
    both = R.with_attachments(hits, attached).orderBy("priority", "rank").collect()
    assert [(r["origin"], r["document"]) for r in both] == [("attachment", "note"), ("index", "a"), ("index", "b")]


def test_fetch_both_ways(spark, monkeypatch):
    hits = spark.createDataFrame([(1, 1), (2, 3)], "query_id int, id int")
    table = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, document string")
    for bound in (10, 0):
        monkeypatch.setattr(R, "FETCH_BROADCAST_ROWS", bound)
        got = R.fetch(hits, table, "id").select("query_id", "document").collect()
        assert sorted(map(tuple, got)) == [(1, "a"), (2, "c")]


def test_spare_copies():
    from trawlnet.operators.topk import without_spare_copies

    x = np.array([[1.0, 2], [0, 0], [1, 2], [1, 2], [3, 4]])
    kept, ids = without_spare_copies(x, np.array([9, 1, 7, 8, 2]), 2)
    assert sorted(zip(ids.tolist(), map(tuple, kept.tolist()))) == [(1, (0, 0)), (2, (3, 4)), (7, (1, 2)), (8, (1, 2))]
    assert without_spare_copies(x[:0], np.zeros(0), 2)[0].shape == (0, 2)


def test_float32_tiles_give_the_exact_rows():
    """Near ties, copies, far offsets and lengths beyond float32 rank as in float64, also over several tiles."""
    from trawlnet.operators.topk import NearestVectors

    rng = np.random.default_rng(12)
    base = rng.normal(size=(5, 7))
    x = np.concatenate([base[rng.integers(0, 5, 3000)] + rng.normal(scale=1e-4, size=(3000, 7)), rng.normal(size=(500, 7)), base])
    q = np.concatenate([x[:600], rng.normal(size=(100, 7))])
    for unit in (1.0, 1e15, 1e25):
        top = NearestVectors(q * unit, 4)
        for low in range(0, len(x), 1500):
            top.offer(x[low : low + 1500] * unit, np.arange(low, min(low + 1500, len(x))))
        rows, found, costs = top.best()
        assert rows.tolist() == np.repeat(np.arange(len(q)), 4).tolist()
        d = ((q[:, None] - x[None]) ** 2).sum(axis=2)
        truth = np.sort(d, axis=1)[:, :4].ravel()
        assert np.allclose(d[rows, found], truth, rtol=1e-9, atol=1.1e-6)
        assert np.allclose(costs / unit**2, truth, rtol=1e-9, atol=1.1e-6)


def test_grid_blocks_do_not_shrink_with_the_broadcast_bound(spark, plan):
    """1,000 queries above a bound of 5 make a few blocks, so items are not copied 200 times; ids may be null."""
    x, q = skewed_vectors(300, 13), skewed_vectors(1000, 14)
    hits = R.knn(frame(spark, q, "query_id"), frame(spark, x, "id"), 3, broadcast_rows=5)
    counts = [int(n) for n in re.findall(r"pmod\(xxhash64\([^()]*\), (\d+)\)", plan(hits))]
    assert counts and max(counts) <= 32
    assert rows(hits) == brute_force(q, x, 3)
    odd = spark.createDataFrame([(None, [0.0, 1.0]), (7, [1.0, 0.0])], "id long, embedding array<float>")
    asked = frame(spark, [[0, 1], [1, 0]], "query_id")
    got = {(r["query_id"], r["rank"]): r["id"] for r in R.knn(asked, odd, 2, broadcast_rows=1).collect()}
    assert got == {(0, 1): None, (0, 2): 7, (1, 1): 7, (1, 2): None}
