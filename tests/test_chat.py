import json

from pyspark.sql import functions as F

from trawlnet.operators import chat as C


def test_inputs_record_omits_missing_fields(spark):
    schema = "message string, project_path string, pinned_repo string, attachments array<string>"
    df = spark.createDataFrame([("m", None, None, None), ("m$1", "/p", "o/r", []), ("", None, "", ["a"])], schema)
    got = [json.loads(r[0]) for r in df.select(C.inputs_record()).collect()]
    assert got == [
        {"message": "m"},
        {"message": "m$1", "project_path": "/p", "pinned_repo": "o/r", "attachments": []},
        {"message": "", "pinned_repo": "", "attachments": ["a"]},
    ]


def test_prompts_take_the_message_literally(spark):
    df = spark.createDataFrame([(1, r"why $1 \d {message}?")], "id int, message string")
    rows = C.prompts(df, keep=["id"]).orderBy("ordinal").collect()
    assert [r["task"] for r in rows] == ["research", "code", "run"]
    assert rows[1]["prompt"] == r"Based on the request 'why $1 \d {message}?', suggest or explain relevant code."
    assert "{message}" not in rows[2]["prompt"]


def test_task_contexts(spark):
    df = spark.createDataFrame(
        [(1, "run", "r"), (1, "research", "a"), (1, "code", "b"), (2, "code", "only")], "request_id int, task string, output string"
    )
    got = {(r["request_id"], r["task"]): r["context"] for r in C.task_contexts(df).collect()}
    assert got == {
        (1, "research"): [], (1, "code"): ["a"], (1, "run"): ["a", "b"],
        (2, "research"): [], (2, "code"): [], (2, "run"): ["only"],
    }


def test_response_and_sources(spark):
    df = spark.createDataFrame(
        [("r", "f", ["s"]), ("", "f", []), (None, "f", None), (None, None, None)], "raw string, final_output string, sources array<string>"
    )
    got = df.select(C.response(F.col("raw"), F.col("final_output")).alias("r"), C.sources_if_any(F.col("sources")).alias("s")).collect()
    assert [(r["r"], r["s"]) for r in got] == [("r", ["s"]), ("f", None), ("f", None), ("", None)]


def test_step_names(spark):
    tasks = [("n", "d"), (None, "d"), ("", "d"), (None, None), ("", ""), ("", None), ("x" * 300, None)]
    df = spark.createDataFrame([(tasks,)], "tasks array<struct<name string, description string>>")
    assert df.select(C.step_names(F.col("tasks"))).first()[0] == ["n", "d", "d", "", "x" * 200]
