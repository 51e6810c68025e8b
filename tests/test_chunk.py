import pytest
from pyspark.sql import functions as F

from trawlnet.functions import keys
from trawlnet.operators.chunk import chunk_lines, line_counts


def chunks(spark, text, size):
    df = spark.createDataFrame([("p", text)], "path string, text string")
    rows = chunk_lines(df, size=size).orderBy("start_line").collect()
    return [(r["text"], r["start_line"], r["end_line"]) for r in rows]


@pytest.mark.parametrize(
    "text,size,expected",
    [
        ("a\nb\nc", 2, [("a\nb", 1, 2), ("c", 3, 3)]),
        ("\n\nc\n", 2, [("c", 3, 3)]),
        (" \n\t", 2, []),
        (" \x1f", 2, []),
        ("", 2, []),
        ("a\r\nb c", 50, [("a\nb\nc", 1, 3)]),
        ("  a\r\nb \n", -1, [("a\nb", None, None)]),
        (" \n", -1, []),
    ],
)
def test_blocks(spark, text, size, expected):
    assert chunks(spark, text, size) == expected


def test_zero_size_is_refused(spark):
    with pytest.raises(ValueError):
        chunks(spark, "a", 0)


@pytest.mark.parametrize("size,golden", [(50, (202, 302, 1929, 485086)), (10, (294, 1944, 3479, 484994))])
def test_golden_totals(spark, tiny, size, golden):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    out = chunk_lines(docs, size=size, keep=["doc_id"])
    row = out.agg(F.count("*"), F.sum("start_line"), F.sum("end_line"), F.sum(F.length("text"))).first()
    assert tuple(row) == golden


@pytest.mark.parametrize("size", [1, 7, 50])
def test_chunks_cover_every_non_blank_line_once(spark, tiny, size):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    covered = {}
    for r in chunk_lines(docs, size=size, keep=["doc_id"]).collect():
        assert r["end_line"] - r["start_line"] + 1 <= size
        for n, line in zip(range(r["start_line"], r["end_line"] + 1), r["text"].split("\n"), strict=True):
            assert covered.setdefault((r["doc_id"], n), line) == line
    for doc_id, text in texts.items():
        for n, line in enumerate(text.splitlines(), 1):
            if line.strip():
                assert covered[(doc_id, n)] == line


def test_chunking_is_map_only_and_reads_two_columns(spark, tiny, plan):
    text = plan(chunk_lines(spark.read.parquet(f"{tiny}/documents.parquet"), keep=["doc_id"]))
    assert "Exchange" not in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_line_counts(spark):
    df = spark.createDataFrame([("a", ""), ("b", "\n"), ("c", "x\ny")], "path string, text string")
    assert {r["path"]: r["n_lines"] for r in line_counts(df).collect()} == {"a": 0, "b": 1, "c": 2}


def test_ordinals_are_dense_and_follow_the_order(spark):
    rows = [(f"p{i % 7}" if i % 3 else "hot", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "path string, start_line int").repartition(5)
    out = keys.with_ordinal(df, ["path", "start_line"]).collect()
    assert [(r["path"], r["start_line"]) for r in sorted(out, key=lambda r: r["ordinal"])] == sorted(rows)
    assert sorted(r["ordinal"] for r in out) == list(range(2000))


def test_keys(spark):
    df = spark.createDataFrame([("/a/x",), ("/b/x",), ("/b/x",), ("/b/y",)], "project_path string")
    assert [tuple(r) for r in keys.name_collisions(df).collect()] == [("code_x", 2, "/a/x", "/b/x")]
    import hashlib

    got = df.select(keys.job_key(F.col("project_path"))).first()[0]
    assert got == "ingest-" + hashlib.sha256(b"/a/x").hexdigest()[:8]
