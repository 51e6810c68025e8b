import os

import pytest

from trawlnet.sources.collection import ParquetStore, check_record, insert_missing, upsert

FIELDS = "collection_id string, id string, document string"


def docs(df, collection_id=None):
    if collection_id:
        df = df.where(f"collection_id = '{collection_id}'")
    return {(r["collection_id"], r["id"]): r["document"] for r in df.collect()}


def rows(spark, *data):
    return spark.createDataFrame(list(data), FIELDS)


def test_merge_rules(spark):
    old = rows(spark, ("a", "1", "old"), ("a", "2", "old"))
    new = rows(spark, ("a", "2", "new"), ("a", "3", "new"), ("a", "3", "new"), ("b", "2", "new"))
    assert docs(insert_missing(old, new)) == {
        ("a", "1"): "old", ("a", "2"): "old", ("a", "3"): "new", ("b", "2"): "new",
    }
    assert insert_missing(old, new).count() == 4
    assert docs(upsert(old, new)) == {("a", "1"): "old", ("a", "2"): "new", ("a", "3"): "new", ("b", "2"): "new"}
    assert upsert(old, new).count() == 4


def test_store_round_trip(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path / "s"))
    assert docs(store.read("a")) == {}
    first = rows(spark, ("a", "1", "x"), ("a", "2", "x"), ("b/c d", "1", "y"))
    store.insert_missing(first)
    store.insert_missing(first)
    assert store.read().count() == 3
    assert docs(store.read("b/c d")) == {("b/c d", "1"): "y"}

    store.upsert(rows(spark, ("a", "2", "new"), ("a", "3", "new")))
    store.insert_missing(rows(spark, ("a", "3", "late"), ("a", "4", "late")))
    assert docs(store.read()) == {
        ("a", "1"): "x", ("a", "2"): "new", ("a", "3"): "new", ("a", "4"): "late", ("b/c d", "1"): "y",
    }
    # an upsert writes its own rows and no other
    written = [d for d in os.listdir(tmp_path / "s") if d.endswith("-put")]
    assert len(written) == 1
    assert spark.read.parquet(str(tmp_path / "s" / written[0])).count() == 2
    store.upsert(rows(spark, ("a", "2", "newer")))
    assert docs(store.read("a")) == {("a", "1"): "x", ("a", "2"): "newer", ("a", "3"): "new", ("a", "4"): "late"}
    before = sorted(map(tuple, store.read().drop("metadata").collect()))
    store.compact()
    assert sorted(map(tuple, store.read().drop("metadata").collect())) == before
    assert [k for _, k in store.record("a").folders] == ["all"]
    store.upsert(rows(spark, ("a", "2", "last")))
    assert docs(store.read())[("a", "2")] == "last" and store.read().count() == 5


def test_unfinished_write_is_ignored(spark, tmp_path, monkeypatch):
    store = ParquetStore(spark, str(tmp_path / "s"))
    store.insert_missing(rows(spark, ("a", "1", "x")))
    monkeypatch.setattr(store, "_note", lambda *_: None)  # lost between its rows and its record
    store.upsert(rows(spark, ("a", "1", "half")))
    monkeypatch.undo()
    assert docs(store.read()) == {("a", "1"): "x"}
    store.upsert(rows(spark, ("a", "1", "whole")))
    assert docs(store.read()) == {("a", "1"): "whole"}


VECTORS = FIELDS + ", embedder string, embedding array<float>"


def test_a_collection_keeps_its_embedder_and_dimension(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path / "s"))

    def write(*data, mode="insert_missing"):
        getattr(store, mode)(spark.createDataFrame(list(data), VECTORS))

    write(("a", "1", "x", "e", [1.0, 2.0]), ("b", "1", "x", "f", [1.0]))
    record = store.record("a")
    assert (record.embedder, record.dimension) == ("e", 2) and store.record("none") is None
    nan, inf = float("nan"), float("inf")
    for bad in ([1.0], [1.0, nan], [1.0, inf], [1.0, None], None):
        for mode in ("insert_missing", "upsert"):
            with pytest.raises(Exception):
                write(("a", "2", "y", "e", bad), mode=mode)
    with pytest.raises(Exception, match="embedded with e"):
        write(("a", "2", "y", "f", [1.0, 2.0]))
    with pytest.raises(Exception):
        write(("c", "1", "y", "e", [1.0]), ("c", "2", "y", "e", [1.0, 2.0]))
    assert docs(store.read()) == {("a", "1"): "x", ("b", "1"): "x"} and store.record("c") is None
    check_record(record, "e", 2)
    for name, dimension in (("f", 2), ("e", 3)):
        with pytest.raises(ValueError):
            check_record(record, name, dimension)


def test_the_newest_version_wins_in_either_mode(spark, tmp_path):
    versions = spark.createDataFrame([("a", "1", "zz", 3), ("a", "1", "aa", 1), ("a", "2", "x", 1)], FIELDS + ", v int")
    for mode in ("insert_missing", "upsert"):
        store = ParquetStore(spark, str(tmp_path / mode))
        getattr(store, mode)(versions, newest_by="v")
        assert docs(store.read()) == {("a", "1"): "zz", ("a", "2"): "x"}


def test_a_read_opens_its_own_collection_only_and_nothing_new_writes_nothing(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path / "s"))
    batch = rows(spark, *[(f"c{i}", "1", "x") for i in range(6)], ("o/d d", "1", "y"))
    store.insert_missing(batch)
    assert len(store.read().inputFiles()) == 7 and len(store.read("c3").inputFiles()) == len(store.read("o/d d").inputFiles()) == 1
    assert store.read("none").count() == 0
    some = store.read_many(spark.createDataFrame([("c1",), ("o/d d",), ("none",)], "collection_id string"))
    assert len(some.inputFiles()) == 2 and docs(some) == {("c1", "1"): "x", ("o/d d", "1"): "y"}
    store.insert_missing(batch)
    assert len([d for d in os.listdir(tmp_path / "s") if d.startswith("batch=")]) == 1


def test_vectors_of_other_or_unnamed_embedders_are_refused(spark):
    from trawlnet.sources.collection import check_embedder

    for name in ("other", None):
        held = spark.createDataFrame([("mine",), (name,)], "embedder string")
        with pytest.raises(ValueError):
            check_embedder(held, "mine")
    check_embedder(held.where("embedder = 'mine'"), "mine")


def test_many_copies_of_one_key(spark):
    copies = rows(spark, *[("a", "hot", f"v{i}") for i in range(500)], ("a", "cold", "v"))
    empty = spark.createDataFrame([], FIELDS)
    assert docs(insert_missing(empty, copies)) == {("a", "hot"): "v0", ("a", "cold"): "v"}


def test_unique_keys_skip_the_second_shuffle(spark, plan):
    old, new = rows(spark, ("a", "1", "old")), rows(spark, ("a", "1", "new"), ("a", "2", "new"))
    assert docs(insert_missing(old, new, unique=True)) == {("a", "1"): "old", ("a", "2"): "new"}
    assert docs(upsert(old, new, unique=True)) == {("a", "1"): "new", ("a", "2"): "new"}
    assert "Aggregate" not in plan(insert_missing(old, new, unique=True))
