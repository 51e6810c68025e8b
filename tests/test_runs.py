import pytest
from pyspark.sql import functions as F

from trawlnet.operators import runs as R


def one(spark, schema, row, expression):
    return spark.createDataFrame([row], schema).select(expression).first()[0]


@pytest.mark.parametrize(
    "command,error",
    [
        (["pytest"], None), (["/usr/bin/python3", "-c"], None), (["Cargo"], None), (["gofmt"], None), (["NODE"], None),
        ([], R.EMPTY_COMMAND), (None, R.EMPTY_COMMAND), (["rm", "-rf", "/"], R.COMMAND_REFUSED), (["npx"], R.COMMAND_REFUSED),
        ([""], R.COMMAND_REFUSED), (["/pytest/"], R.COMMAND_REFUSED), (["mypytest"], R.COMMAND_REFUSED),
    ],
)
def test_command(spark, command, error):
    assert one(spark, "c array<string>", (command,), R.command_error(F.col("c"))) == error


@pytest.mark.parametrize(
    "path,resolved,allowed",
    [
        ("/tmp", "/tmp", True), ("/tmp/", "/tmp", True), ("/tmp/a/../b", "/tmp/b", True), ("//tmp//x/.", "/tmp/x", True),
        ("/tmp2", "/tmp2", False), ("/tmp/../etc", "/etc", False), ("/etc", "/etc", False), ("/../../tmp/x", "/tmp/x", True),
        ("/", "/", False),
    ],
)
def test_path(spark, path, resolved, allowed):
    assert one(spark, "p string", (path,), R.resolve_path(F.col("p"))) == resolved
    assert (one(spark, "p string", (path,), R.path_error(F.col("p"), "/tmp/")) is None) == allowed


def test_path_root_base_and_null(spark):
    assert one(spark, "p string", ("/etc",), R.path_error(F.col("p"), "/")) is None
    assert one(spark, "p string", ("x/../y",), R.resolve_path(F.col("p"), "/srv")) == "/srv/y"
    assert one(spark, "p string", (None,), R.path_error(F.col("p"), "/tmp")) == R.PATH_REFUSED


def test_defaults(spark):
    schema = "id int, project_path string, command array<string>, cwd string, timeout_seconds int"
    df = spark.createDataFrame(
        [(1, "/tmp/a", None, None, None), (2, "/tmp/a", ["npm"], "/etc", 5), (3, "/tmp/a", ["npm"], None, 0)], schema
    )
    got = {r["id"]: r for r in R.with_run_defaults(df, "/tmp").collect()}
    assert set(got) == {1, 2}
    assert (got[1]["command"], got[1]["workdir"], got[1]["timeout_seconds"], got[1]["workdir_outside_root"]) == (["pytest"], "/tmp/a", 300, False)
    assert (got[2]["command"], got[2]["workdir"], got[2]["timeout_seconds"], got[2]["workdir_outside_root"]) == (["npm"], "/etc", 5, True)


RESULT = "code int, out string, err string, took double"


@pytest.mark.parametrize(
    "row,api,tool",
    [
        ((0, " 3 passed \n", "", 0.5), "3 passed", "Exit code: 0. 3 passed (duration: 0.5s)"),
        ((0, "", "", 1.0), "Tests passed", "Exit code: 0. Tests passed. (duration: 1.0s)"),
        ((2, "", " e ", 0.25), "Exit code 2", "Exit code: 2. stderr: e (duration: 0.25s)"),
        ((2, "o", "", 0.25), "o", "Exit code: 2. stderr: o (duration: 0.25s)"),
        ((1, "\n", "\t", 0.25), "Exit code 1", "Exit code: 1. stderr: No output (duration: 0.25s)"),
    ],
)
def test_summaries(spark, row, api, tool):
    c = [F.col(n) for n in ("code", "out", "err", "took")]
    assert one(spark, RESULT, row, R.api_summary(c[0], c[1])) == api
    assert one(spark, RESULT, row, R.tool_summary(*c)) == tool


def test_tool_summary_of_an_empty_result(spark):
    c = [F.col(n) for n in ("code", "out", "err", "took")]
    assert one(spark, RESULT, (None,) * 4, R.tool_summary(*c)) == "Exit code: -1. stderr: No output (duration: 0s)"


@pytest.mark.parametrize("number", [0.0, 1.0, 0.001, 12.345, 299.999, 100000.0])
def test_duration_text_is_pythons(spark, number):
    text = one(spark, RESULT, (0, "x", "", number), R.tool_summary(F.col("code"), F.col("out"), F.col("err"), F.round("took", 3)))
    assert text == f"Exit code: 0. x (duration: {round(number, 3)}s)"


def test_timeouts(spark):
    schema = "timed_out boolean, exit_code int, stdout string, stderr string, duration_raw double"
    df = spark.createDataFrame([(True, None, None, None, 1.23456), (False, 3, "o", "e", 2.0)], schema)
    got = [(r["exit_code"], r["stdout"], r["stderr"], r["duration_seconds"]) for r in R.with_timeouts(df).collect()]
    assert got == [(-1, "", " (timeout)", 1.235), (3, "o", "e", 2.0)]


@pytest.mark.parametrize(
    "outcomes,expected",
    [
        (["ok"], (1, "ok", None)),
        (["connect", "ok", "http_404"], (2, "ok", None)),
        (["http_404", "ok"], (1, "http_404", "runner_unavailable")),
        (["timeout", "http_503", "connect", "ok"], (3, "connect", "runner_unavailable")),
    ],
)
def test_attempts(spark, outcomes, expected):
    df = spark.createDataFrame([(7, i, o) for i, o in enumerate(outcomes, 1)], "request_id int, attempt int, outcome string")
    assert tuple(R.attempt_rollup(df).first()) == (7, *expected)
