"""Index state of many projects and what to do about it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawlnet.functions.keys import job_key

# Fixed values.


def job_status(has_job: Column, succeeded: Column, failed: Column) -> Column:
    """Status from the counts of one job; a job without any count yet is still indexing."""
    return (
        F.when(~has_job, "idle")
        .when(F.coalesce(succeeded, F.lit(0)) >= 1, "ready")
        .when(F.coalesce(failed, F.lit(0)) >= 1, "failed")
        .otherwise("indexing")
    )


def with_jobs(projects: DataFrame, jobs: DataFrame) -> DataFrame:
    """Projects with the counts of their job, looked up by path: its key has 32 bits only, which paths may share."""
    by_path = jobs.groupBy("project_path").agg(
        *[F.max(c).alias(c) for c in ("succeeded", "failed", "active")], F.lit(True).alias("_job")
    )
    return (
        projects.withColumn("job_id", job_key(F.col("project_path")))
        .join(by_path, "project_path", "left")
        .withColumn("has_job", F.coalesce("_job", F.lit(False)))
        .drop("_job")
    )


def index_status(projects: DataFrame, jobs: DataFrame) -> DataFrame:
    return with_jobs(projects, jobs).withColumn(
        "index_status", job_status(F.col("has_job"), F.col("succeeded"), F.col("failed"))
    )


def ingest_plan(projects: DataFrame, jobs: DataFrame) -> DataFrame:
    """``action`` per project: ``create``, ``conflict`` while a job runs, else ``reuse`` the finished one."""
    action = (
        F.when(~F.col("has_job"), "create").when(F.coalesce("active", F.lit(0)) > 0, "conflict").otherwise("reuse")
    )
    one_per_path = projects.groupBy("project_path").agg(F.min("project_id").alias("project_id"))
    return with_jobs(one_per_path, jobs).withColumn("action", action)


def ingest_todo(projects: DataFrame, jobs: DataFrame) -> DataFrame:
    """Paths without a job, once each, with the key their job will get."""
    keyed = projects.select("project_path").distinct().withColumn("job_id", job_key(F.col("project_path")))
    return keyed.join(jobs.select("project_path"), "project_path", "left_anti")


def key_collisions(paths: DataFrame) -> DataFrame:
    """Job keys that several paths share, with the number of paths and the lowest of them."""
    keyed = paths.select("project_path").distinct().withColumn("job_id", job_key(F.col("project_path")))
    shared = keyed.groupBy("job_id").agg(F.count(F.lit(1)).alias("n_paths"), F.min("project_path").alias("first_path"))
    return shared.where("n_paths > 1")


def refresh_status(rows: DataFrame) -> DataFrame:
    """``old_status`` gives way to ``new_status`` only while indexing with a path; NULL means the lookup failed."""
    refreshable = (F.col("old_status") == "indexing") & (F.coalesce("project_path", F.lit("")) != "")
    return rows.withColumn(
        "index_status", F.when(refreshable, F.coalesce("new_status", "old_status")).otherwise(F.col("old_status"))
    )
