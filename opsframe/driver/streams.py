"""Driver queries for the streaming forms: each drains its stream over the
table's parquet file (``availableNow``) into a parquet sink under the
session's checkpoint folder and returns that sink read back as a batch
DataFrame, so it can be compared with its batch twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsframe.driver.jobs import LOG_SPLIT_SQL, PORT_CTES
from opsframe.registry import query
from opsframe.sources.roles import LOGLINE_SPARK, ROLE_SQL, with_roles
from opsframe.streaming import streams as S


def _role_stream(spark, sf, role, base):
    text = LOGLINE_SPARK if role == "logline" else ROLE_SQL[role]
    return spark.sql(text, **{base: S.stream_table(spark, sf, base)})


@query("stream_ingest", oracle=with_roles(LOG_SPLIT_SQL, "joblog"))
def q_stream_ingest(spark, sf):
    """ST-1: validated job-log ingest: append, reject or late for every row."""
    sink, ckpt = S.stream_dirs(spark, "ingest")
    S.ingest_job_log(_role_stream(spark, sf, "joblog", "events"), sink, ckpt)
    ok = spark.read.parquet(f"{sink}/append").select("id", "job_id", "logtype", F.lit("append").alias("route"))
    bad = spark.read.parquet(f"{sink}/reject").select("id", "job_id", "logtype", F.lit("reject").alias("route"))
    late = spark.read.parquet(f"{sink}/late").select("id", "job_id", "logtype", F.lit("late").alias("route"))
    return ok.unionByName(bad).unionByName(late)


@query("stream_tail", oracle=with_roles(
    """SELECT log_id, CAST(line_no AS INTEGER) AS line_no, line FROM (
         SELECT *, row_number() OVER (PARTITION BY log_id ORDER BY line_no DESC) AS rn FROM logline) WHERE rn <= 100""",
    "logline"))
def q_stream_tail(spark, sf):
    """ST-2: rolling last-100 lines per log, newest state per log."""
    sink, ckpt = S.stream_dirs(spark, "tail")
    return S.rolling_tail(_role_stream(spark, sf, "logline", "documents").select("log_id", "line_no", "line"), sink, ckpt, 100)


STEPS_SQL = """
SELECT job_id, title, id AS begin_id, ts AS begin_ts, CASE WHEN ends THEN n_id END AS end_id, CASE WHEN ends THEN n_ts END AS end_ts,
       CASE WHEN ends THEN 'done' ELSE 'unfinished' END AS status
FROM seq WHERE logtype = 'sb' AND (n_id IS NOT NULL OR ts + INTERVAL 1 HOUR < (SELECT max(ts) FROM seq))
UNION ALL
SELECT job_id, title, NULL, NULL, id, ts, 'late_end' FROM seq WHERE logtype = 'se' AND NOT coalesce(p_type = 'sb' AND ts <= p_ts + INTERVAL 1 HOUR, false)"""

STEPS_CTE = """
seq AS (SELECT *, n_type = 'se' AND n_ts <= ts + INTERVAL 1 HOUR AS ends FROM (
  SELECT id, job_id, message AS title, ts, logtype, lead(id) OVER w AS n_id, lead(ts) OVER w AS n_ts, lead(logtype) OVER w AS n_type,
         lag(ts) OVER w AS p_ts, lag(logtype) OVER w AS p_type
  FROM joblog WHERE logtype IN ('sb', 'se') WINDOW w AS (PARTITION BY job_id, message ORDER BY ts, id)))"""


@query("stream_steps", oracle=with_roles(STEPS_SQL, "joblog", extra=STEPS_CTE))
def q_stream_steps(spark, sf):
    """ST-3: step pairing with a one-hour time-out (begins still open at the end are not reported)."""
    sink, ckpt = S.stream_dirs(spark, "steps")
    return S.step_pairs(_role_stream(spark, sf, "joblog", "events"), sink, ckpt)


@query("stream_ports", oracle=with_roles("SELECT id, ts, port, cmd, bundle_name, outcome FROM o", "control", extra=PORT_CTES))
def q_stream_ports(spark, sf):
    """ST-4: live port registry outcomes, equal to W-5."""
    sink, ckpt = S.stream_dirs(spark, "ports")
    return S.port_registry_stream(_role_stream(spark, sf, "control", "events"), sink, ckpt)


HEALTH_METRICS = """
SELECT 'i-' || CAST(user_id % 100 AS STRING) AS host, ts, CAST(floor(value) AS INT) % 101 AS pct,
       CAST(floor(value) AS BIGINT) AS load
FROM {events}"""


@query("stream_health", oracle=f"""
WITH m AS ({HEALTH_METRICS.replace('{events}', 'events').replace('AS STRING', 'AS VARCHAR')})
SELECT host, time_bucket(INTERVAL 60 SECOND, ts) AS window_start,
       time_bucket(INTERVAL 60 SECOND, ts) + INTERVAL 60 SECOND AS window_end,
       max(pct) AS max_pct, round(avg(load), 4) AS avg_load, count(*) AS n
FROM m GROUP BY 1, 2, 3
HAVING time_bucket(INTERVAL 60 SECOND, ts) + INTERVAL 60 SECOND
       <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 2 MINUTE""")
def q_stream_health(spark, sf):
    """ST-5: per-host health per 60 s tumbling window, watermark 2 minutes
    (windows newer than the final watermark are, by design, not emitted)."""
    sink, ckpt = S.stream_dirs(spark, "health")
    metrics = spark.sql(HEALTH_METRICS, events=S.stream_table(spark, sf, "events"))
    S.run_available_now(S.health_windows(metrics).writeStream.format("parquet").outputMode("append")
                        .option("path", sink).option("checkpointLocation", ckpt))
    return spark.read.parquet(sink)
