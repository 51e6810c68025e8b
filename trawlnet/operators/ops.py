"""Rollups over probe results, request metrics and logs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawlnet.functions.keys import with_ordinal

# Fixed values.
CHECKS = ("runner", "store", "llm")
MAX_PROBES = 3
# A check whose address may be left out; the runner's may not.
OPTIONAL_CHECKS = ("store", "llm")
EXCLUDED_ROUTES = ("/metrics",)
LATENCY_BOUNDS = (0.1, 0.5, 1.0)
RUN_EVENT = "crew_run_summary"


def probe_rollup(probes: DataFrame) -> DataFrame:
    """``target, check_name, status``: ok if any of three attempts was, else the last attempt's status.

    A blank ``url``, where the column exists, makes an optional check ``not_configured``.
    """
    tried = probes.where(F.col("attempt") <= MAX_PROBES)
    rolled = F.when(F.max(F.col("status") == "ok"), "ok").otherwise(F.max_by("status", "attempt"))
    if "url" in probes.columns:
        blank = F.max(F.coalesce("url", F.lit(""))) == ""
        rolled = F.when(blank & F.col("check_name").isin(*OPTIONAL_CHECKS), "not_configured").otherwise(rolled)
    return tried.groupBy("target", "check_name").agg(rolled.alias("status"))


def readiness(statuses: DataFrame) -> DataFrame:
    """One wide row per target; ready only when every check is present and ok."""
    wide = statuses.groupBy("target").pivot("check_name", list(CHECKS)).agg(F.first("status"))
    ready = F.lit(True)
    for check in CHECKS:
        ready = ready & (F.coalesce(check, F.lit("")) == "ok")
    return wide.select("target", ready.alias("ready"), *CHECKS, F.when(ready, 200).otherwise(503).alias("status_code"))


def status_class(status: Column) -> Column:
    return F.concat(F.floor(status / 100).cast("string"), F.lit("xx"))


def route_metrics(
    requests: DataFrame,
    *,
    by: Sequence[str] = ("route",),
    latency: str = "latency_seconds",
    bounds: Sequence[float] = LATENCY_BOUNDS,
) -> DataFrame:
    """Count, latency sum and mean, and cumulative latency buckets; unknown and excluded routes are left out."""
    route = F.col(by[0])
    kept = requests.where(route.isNotNull() & ~route.isin(*EXCLUDED_ROUTES))
    buckets = [F.count_if(F.col(latency) <= b).alias(f"le_{str(b).replace('.', '_')}") for b in bounds]
    return kept.groupBy(*by).agg(
        F.count("*").alias("n"), F.sum(latency).alias("latency_sum"), F.avg(latency).alias("latency_avg"), *buckets
    )


def run_outcomes(logs: DataFrame, event: str = RUN_EVENT) -> DataFrame:
    """Runs per outcome with mean and longest duration and mean step count, from summary log records."""
    return (
        logs.where(F.col("event") == event)
        .groupBy("outcome")
        .agg(
            F.count("*").alias("n"),
            F.avg("duration_seconds").alias("avg_seconds"),
            F.max("duration_seconds").alias("max_seconds"),
            F.avg(F.when(F.col("steps").isNotNull(), F.size("steps"))).alias("avg_steps"),
        )
    )


def request_trace(*logs: DataFrame, key: str = "request_id", tie: str = "event_id") -> DataFrame:
    """Records of all services with their ``position`` from 1 in the time order of their request.

    One range sort on (request, time) numbers all records: a request with any number of records spreads over
    partitions and is never gathered. Positions count from the lowest number of the request.
    """
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), logs)
    placed = with_ordinal(both, [key, "ts", tie], "_at")
    first = placed.groupBy(key).agg(F.min("_at").alias("_first"))
    same = placed[key].eqNullSafe(first[key])
    return placed.join(first, same).drop(first[key]).withColumn("position", F.col("_at") - F.col("_first") + 1).drop("_at", "_first")
