"""The given tables, and the record tables Spark derives from them.

No given table holds runs, jobs, probes or requests, so those come from ``events``, ``pages`` and
``conversations`` by the SQL below, which reads the same in Spark and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

GIVEN = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations", "events")

# view -> (source table, SQL)
DERIVED = {
    "run_results": (
        "events",
        """select event_id as request_id, concat('/workspace/u', user_id) as project_path,
  case event_type when 'error' then 1 when 'signup' then -1 else 0 end as exit_code,
  case when event_id % 4 = 0 then '' when event_id % 4 = 1 then concat(' ', props, chr(10)) else props end as stdout,
  case when event_id % 5 = 0 then '' else event_type end as stderr,
  event_type = 'signup' as timed_out, value as duration_raw
from events""",
    ),
    "run_requests": (
        "events",
        """select event_id as request_id,
  case event_id % 10 when 0 then 'pytest -q' when 1 then '/usr/bin/python3 -c pass' when 2 then 'rm -rf /'
    when 3 then 'Cargo test' when 4 then 'gofmt x' when 5 then 'bash' when 6 then 'npx' when 7 then 'node a.js'
    when 8 then null else '' end as command_text,
  case event_id % 6 when 0 then '/tmp' when 1 then '/tmp/a/../b' when 2 then '/tmp2' when 3 then '/tmp/../etc'
    when 4 then '/etc' else concat('/tmp/u', user_id) end as project_path,
  case when event_id % 3 = 0 then '/etc' end as cwd,
  case event_id % 4 when 0 then null when 1 then 0 else cast(event_id % 400 as int) end as timeout_seconds
from events""",
    ),
    "attempts": (
        "events",
        """select cast(floor(event_id / 4) as bigint) as request_id, cast(event_id % 4 as int) + 1 as attempt,
  case event_type when 'view' then 'ok' when 'click' then 'connect' when 'signup' then 'timeout'
    when 'purchase' then 'http_503' else 'http_404' end as outcome
from events""",
    ),
    "projects": (
        "events",
        """select distinct cast(floor(event_id / 50) as bigint) as project_id,
  concat('/workspace/p', cast(floor(event_id / 50) as bigint)) as project_path,
  case cast(floor(event_id / 50) as bigint) % 3 when 0 then 'indexing' when 1 then 'ready' else 'failed' end as old_status
from events""",
    ),
    "jobs": (
        "events",
        """select user_id as project_id, concat('/workspace/p', user_id) as project_path,
  nullif(cast(sum(case when event_type = 'purchase' then 1 else 0 end) as bigint) % 2, 0) as succeeded,
  nullif(cast(sum(case when event_type = 'error' then 1 else 0 end) as bigint) % 2, 0) as failed,
  nullif(cast(sum(case when event_type = 'view' then 1 else 0 end) as bigint) % 2, 0) as active
from events group by user_id""",
    ),
    "probes": (
        "events",
        """select cast(floor(event_id / 12) as bigint) as target,
  case event_id % 3 when 0 then 'runner' when 1 then 'store' else 'llm' end as check_name,
  cast(floor(event_id % 12 / 3) as int) + 1 as attempt,
  case when cast(floor(event_id / 12) as bigint) % 5 = 0 and event_id % 3 <> 1 then '' else 'http://probe' end as url,
  case event_type when 'view' then 'ok' when 'click' then 'timeout' when 'purchase' then 'connection_error' else 'error' end as status
from events""",
    ),
    "http_requests": (
        "events",
        """select event_id, case event_type when 'view' then '/chat' when 'click' then '/run' when 'signup' then '/project'
    when 'purchase' then '/metrics' end as route,
  case event_id % 9 when 0 then 503 when 1 then 404 else 200 end as status,
  value / 100 as latency_seconds
from events""",
    ),
    "request_logs": (
        "events",
        """select concat('r', user_id) as request_id, ts, event_id, case when event_id % 2 = 0 then 'api' else 'runner' end as service,
  event_type as event, round(value, 3) as duration_seconds,
  case when event_type = 'error' then 'failure' else 'success' end as outcome
from events""",
    ),
    "run_logs": (
        "events",
        """select event_id, case when event_type = 'click' then 'http_request' else 'crew_run_summary' end as event,
  case when event_type = 'error' then 'failure' else 'success' end as outcome, round(value, 3) as duration_seconds,
  case when event_type = 'error' then 0 else cast(1 + user_id % 3 as int) end as n_steps
from events""",
    ),
    "given_ids": (
        "events",
        """select event_id, case event_id % 3 when 0 then concat('r', event_id) when 1 then '' end as given from events""",
    ),
    "search_hits": (
        "pages",
        """select cast(floor(page_id / 7) as bigint) as query_id, page_id,
  regexp_extract(html, '(?is)<title>(.*?)</title>', 1) as title,
  url as link, case when page_id % 7 = 0 then null else concat('snippet ', page_id) end as snippet
from pages""",
    ),
    "chat_requests": (
        "conversations",
        """select conv_id, turn, text as message,
  case when turn % 4 = 0 then concat('/workspace/c', conv_id) end as project_path,
  case when conv_id % 3 = 0 then 'owner/repo' end as pinned_repo
from conversations where role = 'user'""",
    ),
    "chat_outputs": (
        "conversations",
        """select conv_id, turn, case when turn % 3 = 0 then '' when turn % 3 = 1 then null else text end as raw,
  case when conv_id % 2 = 0 then text end as final_output, case when turn % 2 = 1 then role end as source
from conversations where role = 'assistant'""",
    ),
    "task_outputs": (
        "conversations",
        """select concat(conv_id, '-', cast(floor(turn / 3) as bigint)) as request_id, turn,
  case turn % 3 when 0 then 'research' when 1 then 'code' else 'run' end as task,
  case turn % 4 when 1 then '' when 2 then role when 3 then concat(role, ' ', turn) end as name,
  case when turn % 5 = 0 then null else text end as description, text as output
from conversations""",
    ),
}

SMALL_BYTES = 256 << 20


class Tables:
    """Reads ``<folder>/<table>.parquet`` and the derived tables on top."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __call__(self, name: str) -> DataFrame:
        if name in DERIVED:
            source, sql = DERIVED[name]
            return self.spark.sql(sql.replace(f"from {source}", "from {source}"), source=self(source))
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, name: str, key: str, *columns: str) -> DataFrame:
        """A table for heavy row work. A few small files have too few row groups to use all cores, so
        those rows are shared out first; large tables are split by the scan itself."""
        df = self(name).select(key, *columns)
        width = self.spark.sparkContext.defaultParallelism
        size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        if size < SMALL_BYTES and len(df.inputFiles()) < width:
            return df.repartition(width, key)
        return df


def derived_sql(*names: str) -> str:
    """``with`` clause that gives DuckDB the derived tables."""
    return "with " + ",\n".join(f"{n} as ({DERIVED[n][1]})" for n in names)
