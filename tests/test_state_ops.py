import json

import pytest
from pyspark.sql import functions as F

from trawlnet.operators import ops as O
from trawlnet.operators import state as S
from trawlnet.sources.logs import read_logs


@pytest.fixture
def projects(spark):
    paths = ["/none", "/empty", "/won", "/lost", "/both", "/busy"]
    return spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "project_id int, project_path string")


@pytest.fixture
def jobs(spark):
    return spark.createDataFrame(
        [("/empty", None, None, None), ("/won", 1, None, None), ("/lost", 0, 2, 0), ("/both", 1, 1, 0), ("/busy", 0, 0, 1)],
        "project_path string, succeeded int, failed int, active int",
    )


def test_status_and_plan(projects, jobs):
    status = {r["project_path"]: r["index_status"] for r in S.index_status(projects, jobs).collect()}
    assert status == {"/none": "idle", "/empty": "indexing", "/won": "ready", "/lost": "failed", "/both": "ready", "/busy": "indexing"}
    twice = projects.unionByName(projects)
    plan = [(r["project_path"], r["action"]) for r in S.ingest_plan(twice, jobs).collect()]
    assert sorted(plan) == sorted(
        {"/none": "create", "/empty": "reuse", "/won": "reuse", "/lost": "reuse", "/both": "reuse", "/busy": "conflict"}.items()
    )
    assert [r["project_path"] for r in S.ingest_todo(twice, jobs).collect()] == ["/none"]


def test_refresh(spark):
    df = spark.createDataFrame(
        [(1, "indexing", "/p", "ready"), (2, "indexing", "/p", None), (3, "failed", "/p", "ready"), (4, "indexing", None, "ready"), (5, "indexing", "", "idle")],
        "i int, old_status string, project_path string, new_status string",
    )
    got = {r["i"]: r["index_status"] for r in S.refresh_status(df).collect()}
    assert got == {1: "ready", 2: "indexing", 3: "failed", 4: "indexing", 5: "indexing"}


def test_probes_and_readiness(spark):
    rows = [
        (1, "runner", 1, "timeout", "u"), (1, "runner", 2, "ok", "u"), (1, "store", 1, "ok", "u"), (1, "llm", 1, "ok", "u"),
        (2, "runner", 1, "ok", ""), (2, "store", 1, "ok", "u"), (2, "llm", 1, "ok", ""),
        (3, "runner", 1, "timeout", "u"), (3, "runner", 2, "error", "u"), (3, "runner", 3, "connection_error", "u"), (3, "runner", 4, "ok", "u"),
    ]
    probes = spark.createDataFrame(rows, "target int, check_name string, attempt int, status string, url string")
    rolled = O.probe_rollup(probes)
    got = {(r["target"], r["check_name"]): r["status"] for r in rolled.collect()}
    assert got[1, "runner"] == "ok" and got[2, "runner"] == "ok" and got[2, "llm"] == "not_configured"
    assert got[3, "runner"] == "connection_error"
    ready = {r["target"]: (r["ready"], r["status_code"], r["store"]) for r in O.readiness(rolled).collect()}
    assert ready == {1: (True, 200, "ok"), 2: (False, 503, "ok"), 3: (False, 503, None)}


def test_route_metrics(spark):
    df = spark.createDataFrame(
        [("/chat", 0.05), ("/chat", 0.5), ("/chat", 9.0), ("/metrics", 1.0), (None, 1.0)], "route string, latency_seconds double"
    )
    row = O.route_metrics(df).collect()
    assert len(row) == 1
    assert (row[0]["route"], row[0]["n"], row[0]["le_0_1"], row[0]["le_0_5"], row[0]["le_1_0"]) == ("/chat", 3, 1, 2, 2)
    assert df.select(O.status_class(F.lit(404))).first()[0] == "4xx"


def test_logs(spark, tmp_path):
    lines = [
        {"event": "crew_run_summary", "request_id": "r1", "outcome": "success", "duration_seconds": 2.0, "steps": ["a", "b"], "timestamp": "t1"},
        {"event": "crew_run_summary", "request_id": "r2", "outcome": "failure", "duration_seconds": 4.0, "steps": [], "extra": {"x": 1}},
        {"event": "graceful_shutdown", "message": "bye"},
    ]
    (tmp_path / "log.json").write_text("\n".join([json.dumps(x) for x in lines] + ["not json"]))
    logs = read_logs(spark, str(tmp_path / "log.json")).cache()
    assert [r["_corrupt_record"] for r in logs.where("_corrupt_record is not null").collect()] == ["not json"]
    got = {r["outcome"]: (r["n"], r["avg_seconds"], r["max_seconds"], r["avg_steps"]) for r in O.run_outcomes(logs).collect()}
    assert got == {"success": (1, 2.0, 2.0, 2.0), "failure": (1, 4.0, 4.0, 0.0)}


def test_paths_with_one_key_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(S, "job_key", lambda path: F.lit("same"))
    projects = spark.createDataFrame([(1, "/a"), (2, "/b")], "project_id int, project_path string")
    jobs = spark.createDataFrame([("/a", 1, 0, 0)], "project_path string, succeeded int, failed int, active int")
    assert [r["project_path"] for r in S.ingest_todo(projects, jobs).collect()] == ["/b"]
    assert {r["project_id"]: r["action"] for r in S.ingest_plan(projects, jobs).collect()} == {1: "reuse", 2: "create"}
    assert [tuple(r) for r in S.key_collisions(projects).collect()] == [("same", 2, "/a")]


def test_trace_orders_across_services(spark):
    api = spark.createDataFrame([("r", 1, 10, "api"), ("r", 3, 11, "api"), ("q", 9, 12, "api")], "request_id string, ts int, event_id int, service string")
    runner = spark.createDataFrame([("r", 2, 13, "runner", "x")], "request_id string, ts int, event_id int, service string, event string")
    rows = sorted((r["request_id"], r["position"], r["ts"], r["service"]) for r in O.request_trace(api, runner).collect())
    assert rows == [("q", 1, 9, "api"), ("r", 1, 1, "api"), ("r", 2, 2, "runner"), ("r", 3, 3, "api")]
