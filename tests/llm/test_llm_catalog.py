"""Every registered query of these operators: its contract, its SQL, and that it pairs no rows without a key."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from trawlnet.llm.catalog import ORACLES, QUERIES

#: Leading columns of each result, and whether it has a row for every document.
CONTRACTS = {
    "op1": ("doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean", True),
    "op2": ("doc_id bigint, held_out boolean, score double, predicted int", True),
    "op3": ("doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int", True),
    "op4": ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean", True),
    "op5": ("doc_id bigint, n_shingles bigint, component_id bigint, kept boolean", True),
    "op6": ("doc_id bigint", False),
    "op7": ("doc_id bigint", False),
    "op8": ("doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string", True),
    "op9": ("doc_id bigint", False),
    "op10": ("doc_id bigint", False),
    "op13": ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint", False),
    "op12": (
        "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string",
        True,
    ),
    "op11": ("doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean", True),
}


def test_all_are_registered():
    names = set(entry_points.queries())
    assert names >= {*QUERIES, "pipeline"} and {q.split("_")[0] for q in QUERIES} == set(CONTRACTS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tiny, documents, plan, name):
    columns, whole = CONTRACTS[name.split("_")[0]]
    df = QUERIES[name](spark, tiny)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes).startswith(columns)
    text = plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    rows = df.collect()
    assert rows
    if whole:
        assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in documents.select("doc_id").collect())
        assert not any(v is None for r in rows for k, v in r.asDict().items() if k != "grown_shard")
    if name in ORACLES:
        con = duckdb.connect()
        con.sql(f"create view documents as select * from '{tiny}/documents.parquet'")
        cursor = con.execute(ORACLES[name])
        order = [c[0] for c in cursor.description]
        assert sorted(tuple(r[c] for c in order) for r in rows) == sorted(cursor.fetchall())
