import os

import pytest

from trawlnet.operators.embed import function_embedder
from trawlnet.plans.answer import query_collection, query_collections, rag_contexts
from trawlnet.plans.ingest import ingest_project, store_documents
from trawlnet.session import cut_lineage
from trawlnet.sources.collection import ParquetStore, ViewStore, open_store
from trawlnet.sources.tree import TreeReader, list_tree, read_files, scan_file, scan_tree, write_tree

READ = ["a.py", "sub/C.PY", "a..py", "__init__.py", "_priv/e.py", ".b.py", ".hid/d.py", "empty.py"]
SKIPPED = [".py", "..py", "a", "a.", "a.py.txt", "x.tsx"]


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "proj"
    for name in READ + SKIPPED:
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("" if name == "empty.py" else f"first {name}\nsecond\n")
    (root / "bad.md").write_bytes(b"ok \xff\nline")
    with open(os.fsencode(root) + b"/n\xff.js", "w") as f:
        f.write("odd name")
    os.symlink(root / "sub", root / "link_dir")
    os.symlink(root / "a.py", root / "link.py")
    os.symlink(root / "gone", root / "broken.py")
    return root


def test_scan_reads_exactly_the_wanted_files(spark, tree):
    rows = {os.path.relpath(r["path"], tree): r["text"] for r in scan_tree(spark, str(tree)).collect()}
    assert sorted(rows) == sorted(READ + ["bad.md", "link.py", "n\ufffd.js"])
    assert rows["bad.md"] == "ok �\nline"
    assert rows["sub/C.PY"] == "first sub/C.PY\nsecond\n"


def test_an_arrow_file_system_gives_the_same(spark, tree):
    os.remove(os.fsencode(tree) + b"/n\xff.js")
    os.remove(tree / "link_dir")  # Arrow follows links to directories, which stores do not have
    plain = {(r["path"], r["text"]) for r in scan_tree(spark, str(tree)).collect()}
    remote = {(r["path"].removeprefix("file://"), r["text"]) for r in scan_tree(spark, f"file://{tree}", arrow=True).collect()}
    assert remote == plain and len(plain) == len(READ) + 2


@pytest.mark.parametrize("arrow", [False, True])
def test_write_then_scan(spark, tmp_path, arrow):
    files = spark.createDataFrame([(f"d{i % 3}/_x/{i}.md", bytearray(b"t%d" % i)) for i in range(40)], "name string, content binary")
    root = f"file://{tmp_path}/w"
    assert write_tree(files, root, arrow) == 40
    got = {r["path"].rsplit("/w/", 1)[1]: r["text"] for r in scan_tree(spark, root, arrow=arrow).collect()}
    assert got == {f"d{i % 3}/_x/{i}.md": f"t{i}" for i in range(40)}


def test_planning_shares_out_directories_and_listing_is_one_job(spark, tmp_path):
    for i in range(30):
        deep = tmp_path / "p" / f"a{i}" / "b" / "c" / "d" / "e"
        deep.mkdir(parents=True)
        (deep / "f.py").write_text("x")
        (tmp_path / "p" / f"a{i}" / "g.py").write_text("y")
    reader = TreeReader({"root": str(tmp_path / "p"), "shares": "8"})
    shares = reader.partitions()
    assert len(shares) == 8 and sum(len(s.whole) for s in shares) == 30 and sum(len(s.upper) for s in shares) == 1
    names = [b for s in shares for batch in reader.read(s) for b in batch.column("raw").to_pylist()]
    assert len(names) == len(set(names)) == 60
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "listing")
    assert len(list_tree(spark, str(tmp_path / "p")).collect()) == 60
    assert len(tracker.getJobIdsForGroup("listing")) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_files_that_vanish_give_no_row(spark, tree):
    listed = cut_lineage(list_tree(spark, str(tree)))
    os.remove(tree / "a.py")
    os.remove(tree / "sub" / "C.PY")
    names = {os.path.relpath(r["path"], tree) for r in read_files(listed, str(tree)).collect()}
    assert "a.py" not in names and "link.py" not in names and "a..py" in names


def test_scan_of_a_missing_path_is_empty_but_a_job_fails(spark, tmp_path):
    assert scan_tree(spark, str(tmp_path / "none")).count() == 0
    assert scan_file(spark, str(tmp_path / "none.py")).count() == 0
    with pytest.raises(NotADirectoryError):
        ingest_project(spark, str(tmp_path / "none"), ParquetStore(spark, str(tmp_path / "store")))


def constant_embedder():
    return function_embedder("constant", 8, lambda texts: [[0.1] * 8 for _ in texts])


def test_ingest_then_query(spark, tree, tmp_path):
    store = open_store(spark, str(tmp_path / "store"))
    assert isinstance(store, ParquetStore)
    ingest_project(spark, str(tree), store)
    rows = store.read("code_proj").orderBy("id").collect()
    assert len(rows) == 10  # eleven files, one of them empty
    assert {r["id"] for r in rows} == {f"chunk_{i}" for i in range(10)}
    by_number = sorted(rows, key=lambda r: int(r["id"].split("_")[1]))
    assert [r["path"] for r in by_number] == sorted(r["path"] for r in rows)
    assert all(len(r["embedding"]) == 64 and r["embedder"] == "hash64" for r in rows)

    ingest_project(spark, str(tree), store)  # same ids: nothing is added
    assert store.read("code_proj").count() == 10

    queries = spark.createDataFrame([(1, "first a.py second"), (2, "bad ok line")], "query_id int, text string")
    hits = query_collection(store, "code_proj", queries, 3)
    got = hits.where("rank = 1 and query_id = 2").first()
    assert got["path"].endswith("bad.md") and (got["start_line"], got["end_line"]) == (1, 2)
    assert hits.count() == 6
    contexts = {r["query_id"]: r["context"] for r in rag_contexts(store, "code_proj", queries, 2).collect()}
    assert contexts[2].startswith("ok �\nline\n\n---\n\n")
    nothing = {r["context"] for r in rag_contexts(store, "code_absent", queries).collect()}
    assert nothing == {"No results found."}


def test_another_embedder_is_refused(spark, tree, tmp_path):
    store = ParquetStore(spark, str(tmp_path / "store"))
    ingest_project(spark, str(tree), store, embedder=constant_embedder(), collection_id="c")
    queries = spark.createDataFrame([(1, "x")], "query_id int, text string")
    with pytest.raises(ValueError, match="constant"):
        query_collection(store, "c", queries)
    assert query_collection(store, "c", queries, embedder=constant_embedder()).count() == 5


def test_a_tree_without_text_leaves_no_collection(spark, tmp_path):
    (tmp_path / "proj").mkdir()
    (tmp_path / "proj" / "blank.py").write_text(" \n")
    store = ParquetStore(spark, str(tmp_path / "store"))
    ingest_project(spark, str(tmp_path / "proj"), store)
    assert not (tmp_path / "store").exists()
    assert store.read().count() == 0


def test_session_store(spark, tree):
    store = open_store(spark)
    assert isinstance(store, ViewStore)
    ingest_project(spark, str(tree), store, ids="content")
    assert store.read("code_proj").where("id like '%a.py:1'").count() == 1
    ingest_project(spark, str(tree), store, ids="content", mode="upsert")
    assert store.read("code_proj").count() == 10


@pytest.mark.parametrize("path", [None, "store"])
def test_documents_with_metadata(spark, tmp_path, path):
    store = open_store(spark, path and str(tmp_path / path))
    schema = "n int, document string, metadata map<string,string>"
    texts = ["vector database", "web server", "test runner"]
    a = spark.createDataFrame([(i, t, {"source": "s", "line": str(i)}) for i, t in enumerate(texts)], schema)
    store_documents(a, "a", store, order_by=["n"])
    store_documents(a.drop("metadata").where("n > 0"), "b", store, order_by=["n"])
    queries = spark.createDataFrame([(1, "a", "vector database"), (2, "b", "vector database"), (3, "none", "x")], "query_id int, collection_id string, text string")
    hits = query_collection(store, "a", queries.where("query_id = 1"), 3).orderBy("rank").collect()
    assert len(hits) == 3 and (hits[0]["id"], hits[0]["metadata"], hits[0]["distance"]) == ("chunk_0", {"source": "s", "line": "0"}, 0.0)
    assert query_collection(store, "b", queries.where("query_id = 2"), 5).count() == 2
    both = query_collections(store, queries, 5).collect()
    assert sorted((r["query_id"], r["collection_id"], r["id"]) for r in both) == [
        (1, "a", "chunk_0"), (1, "a", "chunk_1"), (1, "a", "chunk_2"), (2, "b", "chunk_0"), (2, "b", "chunk_1"),
    ]
    assert {r["document"] for r in both if r["query_id"] == 2} == {"web server", "test runner"}
