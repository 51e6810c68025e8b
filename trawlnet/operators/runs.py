"""Audits and summaries of command-run requests and results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawlnet.functions.text import basename, first_non_empty, strip

# Fixed values.
COMMAND_PREFIXES = ("pytest", "npm", "cargo", "go", "python", "node")
DEFAULT_COMMAND = ("pytest",)
DEFAULT_TIMEOUT = 300
MAX_ATTEMPTS = 3
EMPTY_COMMAND = "command cannot be empty"
COMMAND_REFUSED = "command executable not in allowlist"
PATH_REFUSED = "project_path must be under ALLOWED_ROOT"
INVALID = "invalid_input"


def command_error(command: Column) -> Column:
    """Why a command is refused, NULL when it may run. The executable needs an allowed prefix only."""
    executable = F.lower(basename(F.get(command, 0)))
    allowed = executable.rlike("^(" + "|".join(COMMAND_PREFIXES) + ")")
    return F.when(F.coalesce(F.size(command), F.lit(0)) < 1, EMPTY_COMMAND).when(~allowed, COMMAND_REFUSED)


def resolve_path(path: Column, base: str = "/") -> Column:
    """Absolute path without ``.``, ``..`` and empty components, by text alone (links are not followed).

    ``base`` is where relative paths start.
    """
    absolute = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit(base + "/"), path))
    parts = F.filter(F.split(absolute, "/", -1), lambda p: (p != "") & (p != "."))
    resolved = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, p: F.when(p == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(
            F.concat(acc, F.array(p))
        ),
    )
    return F.concat(F.lit("/"), F.array_join(resolved, "/"))


def is_under(path: Column, root: str) -> Column:
    """Whether the resolved path is the root or below it by whole components."""
    top = "/" + "/".join(p for p in root.split("/") if p)
    resolved = resolve_path(path)
    return F.lit(True) if top == "/" else (resolved == top) | F.startswith(resolved, F.lit(top + "/"))


def path_error(path: Column, root: str) -> Column:
    return F.when(~F.coalesce(is_under(path, root), F.lit(False)), PATH_REFUSED)


def code_for(error: Column) -> Column:
    return F.when(error.isNotNull(), INVALID)


def with_run_defaults(requests: DataFrame, root: str) -> DataFrame:
    """Effective ``command, workdir, timeout_seconds``; requests with a timeout below 1 are rejected.

    ``workdir_outside_root`` flags requests whose working directory would leave the allowed root.
    """
    timeout = F.coalesce("timeout_seconds", F.lit(DEFAULT_TIMEOUT))
    workdir = F.coalesce("cwd", "project_path")
    return requests.where(timeout >= 1).withColumns(
        {
            "command": F.coalesce("command", F.array(*[F.lit(c) for c in DEFAULT_COMMAND])),
            "workdir": workdir,
            "timeout_seconds": timeout,
            "workdir_outside_root": ~is_under(workdir, root),
        }
    )


def api_summary(exit_code: Column, stdout: Column) -> Column:
    fallback = F.when(exit_code == 0, "Tests passed").otherwise(F.concat(F.lit("Exit code "), exit_code.cast("string")))
    return first_non_empty(strip(F.coalesce(stdout, F.lit(""))), fallback)


def tool_summary(exit_code: Column, stdout: Column, stderr: Column, duration: Column) -> Column:
    """One line per result. ``duration`` is a number column; its text is the column's own cast to string."""
    out, err = (strip(F.coalesce(c, F.lit(""))) for c in (stdout, stderr))
    code = F.coalesce(exit_code, F.lit(-1))
    took = F.concat(F.lit(" (duration: "), F.coalesce(duration.cast("string"), F.lit("0")), F.lit("s)"))
    passed = F.concat(F.lit("Exit code: 0. "), first_non_empty(out, "Tests passed."), took)
    failed = F.concat(
        F.lit("Exit code: "), code.cast("string"), F.lit(". stderr: "), first_non_empty(err, out, "No output"), took
    )
    return F.when(code == 0, passed).otherwise(failed)


def with_timeouts(results: DataFrame) -> DataFrame:
    """Timed-out runs get exit code -1 and a marked stderr; durations keep three decimals."""
    late = F.coalesce(F.col("timed_out"), F.lit(False))
    err = F.coalesce("stderr", F.lit(""))
    return results.withColumns(
        {
            "exit_code": F.when(late, -1).otherwise(F.col("exit_code")),
            "stdout": F.coalesce("stdout", F.lit("")),
            "stderr": F.when(late, F.concat(err, F.lit(" (timeout)"))).otherwise(err),
            "duration_seconds": F.round("duration_raw", 3),
        }
    )


def is_transient(outcome: Column) -> Column:
    """Connection trouble, timeouts and 5xx replies are tried again."""
    return outcome.isin("connect", "timeout") | outcome.rlike("^http_5")


def attempt_rollup(attempts: DataFrame) -> DataFrame:
    """``request_id, attempts, final_outcome, error``: the first settled attempt of three, else the third."""
    used = attempts.where(F.col("attempt") <= MAX_ATTEMPTS)
    settled = F.when(~is_transient(F.col("outcome")), F.struct("attempt", "outcome"))
    final = F.coalesce("first_settled", "last_tried")
    return (
        used.groupBy("request_id")
        .agg(F.min(settled).alias("first_settled"), F.max(F.struct("attempt", "outcome")).alias("last_tried"))
        .select(
            "request_id",
            final["attempt"].alias("attempts"),
            final["outcome"].alias("final_outcome"),
            F.when(final["outcome"] != "ok", "runner_unavailable").alias("error"),
        )
    )
