"""JSON-lines log scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LOG_SCHEMA = (
    "timestamp string, level string, event string, request_id string, outcome string, "
    "duration_seconds double, steps array<string>, error string, message string, exception string, "
    "_corrupt_record string"
)


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """One record per line; a line that is not JSON is kept in ``_corrupt_record``."""
    return spark.read.schema(LOG_SCHEMA).option("mode", "PERMISSIVE").json(path)
