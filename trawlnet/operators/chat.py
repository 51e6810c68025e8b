"""Preparing requests for a model and reading its records, over tables of both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawlnet.functions.text import first_non_empty

# The three tasks of a request in running order, each with its prompt.
TASKS = (
    (1, "research", "Research the topic or question: {message}. Use your search tool and summarize findings."),
    (2, "code", "Based on the request '{message}', suggest or explain relevant code."),
    (3, "run", "Run tests (using your run tool) and report whether they passed."),
)
# Which earlier tasks a task may read.
TASK_CONTEXT = {"research": (), "code": ("research",), "run": ("research", "code")}
STEP_CHARS = 200


def inputs_record(optional: Sequence[str] = ("project_path", "pinned_repo", "attachments")) -> Column:
    """JSON of the message and of whichever optional fields are not NULL."""
    return F.to_json(F.struct("message", *optional), {"ignoreNullFields": "true"})


def task_prompts(message: Column) -> Column:
    """Array of ``(ordinal, task, prompt)``, one per task. Literal replacement: messages may hold ``$``."""
    return F.array(
        *[
            F.struct(
                F.lit(n).alias("ordinal"),
                F.lit(name).alias("task"),
                F.replace(F.lit(template), F.lit("{message}"), message).alias("prompt"),
            )
            for n, name, template in TASKS
        ]
    )


def prompts(requests: DataFrame, *, keep: Sequence[str], message: str = "message") -> DataFrame:
    """Three rows per request, ``keep..., ordinal, task, prompt``; no join, the tasks ride along each row."""
    return requests.select(*keep, F.inline(task_prompts(F.col(message))))


def task_contexts(outputs: DataFrame) -> DataFrame:
    """``request_id, task, context``: the outputs of the tasks each task may read, in running order.

    ``outputs`` has ``request_id, task, output``; a request has one output per task, so its row
    stays small and one aggregation serves all three tasks.
    """
    by_task = outputs.groupBy("request_id").agg(
        *[F.max(F.when(F.col("task") == name, F.col("output"))).alias(name) for _, name, _ in TASKS]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("task"),
                F.array_compact(F.array(*[F.col(c) for c in TASK_CONTEXT[name]]).cast("array<string>")).alias("context"),
            )
            for _, name, _ in TASKS
        ]
    )
    return by_task.select("request_id", F.inline(rows))


def response(raw: Column, final_output: Column) -> Column:
    return first_non_empty(raw, F.coalesce(final_output, F.lit("")))


def sources_if_any(sources: Column) -> Column:
    return F.when(F.size(sources) > 0, sources)


def step_names(tasks: Column) -> Column:
    """Names of finished tasks, else their descriptions, cut to a fixed length; tasks with neither are skipped."""
    labels = F.transform(tasks, lambda t: first_non_empty(t["name"], t["description"]))
    return F.transform(F.filter(labels, lambda x: x.isNotNull()), lambda x: F.substring(x, 1, STEP_CHARS))
