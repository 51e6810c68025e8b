"""Every registered query against its DuckDB counterpart on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from trawlnet.catalog.queries import ORACLES, QUERIES

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations", "events")


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{tiny}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(0.0 if r[i] == 0 else r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, tiny, name):
    df = QUERIES[name](spark, tiny)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLES[name])
    assert got == canonical([c[0] for c in cursor.description], cursor.fetchall())
    assert got[1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_has_rows(spark, tiny, name):
    assert QUERIES[name](spark, tiny).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_rows_without_a_key(spark, tiny, plan, name):
    text = plan(QUERIES[name](spark, tiny))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["query_id", "rank", "id", "distance"]
    assert df.count() == 200


def test_every_query_of_this_catalog_is_registered():
    assert QUERIES.keys() <= entry_points.queries().keys() and ORACLES.keys() <= entry_points.oracle_sql().keys()
