"""Driver queries over the job log, task results and control commands."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsframe.operators import aggregates as A
from opsframe.operators.filters import split_valid_log
from opsframe.operators.joins import queue_routing
from opsframe.plans import jobs
from opsframe.registry import query
from opsframe.sources.roles import Roles, with_roles

EPOCH = "CAST(floor(epoch({0})) AS BIGINT)"

STEP_SPANS_SQL = f"""
SELECT job_id, message AS title, id AS begin_id, ts AS begin_ts,
       CASE WHEN nt = 'se' THEN nid END AS end_id, CASE WHEN nt = 'se' THEN nts END AS end_ts,
       CASE WHEN nt = 'se' THEN 'done' ELSE 'unfinished' END AS status,
       CASE WHEN nt = 'se' THEN {EPOCH.format('nts')} - {EPOCH.format('ts')} END AS duration_s
FROM (SELECT *, lead(logtype) OVER w AS nt, lead(ts) OVER w AS nts, lead(id) OVER w AS nid
      FROM joblog WHERE logtype IN ('sb', 'se')
      WINDOW w AS (PARTITION BY job_id, message ORDER BY ts, id))
WHERE logtype = 'sb'"""


@query("step_spans", oracle=with_roles(STEP_SPANS_SQL, "joblog"))
def q_step_spans(spark, sf):
    return jobs.job_steps(Roles(spark, sf).joblog)


STEP_MESSAGES_SQL = """
SELECT job_id, mk.i AS step_begin_id, mk.m AS step_title, count(*) AS n_messages,
       count(*) FILTER (WHERE logtype = 'w') AS n_warnings, count(*) FILTER (WHERE logtype = 'e') AS n_errors
FROM (SELECT *, last_value(CASE WHEN logtype IN ('sb', 'se') THEN struct_pack(t := logtype, i := id, m := message) END
                           IGNORE NULLS) OVER (PARTITION BY job_id ORDER BY ts, id
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mk
      FROM joblog)
WHERE mk.t = 'sb' AND logtype NOT IN ('sb', 'se')
GROUP BY job_id, mk.i, mk.m"""


@query("step_messages", oracle=with_roles(STEP_MESSAGES_SQL, "joblog"))
def q_step_messages(spark, sf):
    return jobs.step_messages(Roles(spark, sf).joblog)


PORT_CTES = """
c AS (SELECT *, coalesce(sum(CASE WHEN cmd = 'unserve' THEN 1 ELSE 0 END) OVER (PARTITION BY port ORDER BY ts, id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island,
             cmd = 'serve' AND regexp_full_match(bundle_name, '[0-9A-Za-z_-]+') AS valid
      FROM control),
w AS (SELECT port, island, id AS wid FROM (
        SELECT *, row_number() OVER (PARTITION BY port, island ORDER BY ts, id) AS rn FROM c WHERE valid) WHERE rn = 1),
o AS (SELECT c.id, c.ts, c.port, c.cmd, c.bundle_name, CAST(c.island AS BIGINT) AS island,
             CASE WHEN c.cmd = 'unserve' THEN CASE WHEN w.wid IS NOT NULL THEN 'ok' ELSE 'error_not_served' END
                  WHEN w.wid IS NULL THEN 'refused_name'
                  WHEN c.id = w.wid THEN 'ok'
                  WHEN (c.ts, c.id) < (SELECT (x.ts, x.id) FROM control x WHERE x.id = w.wid) THEN 'refused_name'
                  ELSE 'refused_busy' END AS outcome
      FROM c LEFT JOIN w ON c.port = w.port AND c.island = w.island)"""


@query("port_outcomes", oracle=with_roles("SELECT * FROM o", "control", extra=PORT_CTES))
def q_port_outcomes(spark, sf):
    return jobs.port_outcomes(Roles(spark, sf).control)


PORT_REGISTRY_SQL = """
SELECT o.port, o.bundle_name, o.id AS since_id, o.ts AS since_ts
FROM o JOIN (SELECT port, count(*) FILTER (WHERE cmd = 'unserve') AS island FROM o GROUP BY port) l
  ON o.port = l.port AND o.island = l.island
WHERE o.cmd = 'serve' AND o.outcome = 'ok'"""


@query("port_registry", oracle=with_roles(PORT_REGISTRY_SQL, "control", extra=PORT_CTES))
def q_port_registry(spark, sf):
    return jobs.port_registry(Roles(spark, sf).control)


ROUND_ROBIN_CTES = """
w AS (SELECT project_id, id AS worker_id, row_number() OVER (PARTITION BY project_id ORDER BY id) - 1 AS worker_no
      FROM deployment WHERE deactivation_date IS NULL),
n AS (SELECT project_id, count(*) AS n FROM w GROUP BY project_id),
q AS (SELECT id, job_id, ts, row_number() OVER (PARTITION BY job_id ORDER BY ts, id) - 1 AS k FROM joblog)"""

ROUND_ROBIN_SQL = """
SELECT q.id, q.job_id, q.ts, CAST(q.k % n.n AS INTEGER) AS slot, w.worker_id
FROM q LEFT JOIN n ON n.project_id = q.job_id
LEFT JOIN w ON w.project_id = q.job_id AND w.worker_no = q.k % n.n"""


@query("round_robin", oracle=with_roles(ROUND_ROBIN_SQL, "joblog", "deployment", extra=ROUND_ROBIN_CTES))
def q_round_robin(spark, sf):
    """W-2: every request (log row) of a project goes to the next of the project's
    active workers in turn (pointer + 1 per request, worker list by id)."""
    r = Roles(spark, sf)
    req = r.joblog.select("id", F.col("job_id").alias("project_id"), "ts")
    workers = r.deployment.filter(F.col("deactivation_date").isNull()).select("project_id", "id")
    out = jobs.round_robin_workers(req, workers, "project_id", "id")
    return out.select("id", F.col("project_id").alias("job_id"), "ts", "slot", "worker_id")


JOB_DURATIONS_SQL = f"""
SELECT j.id, j.project_id, j.task_id, j.jobcode, j.issued_at, t.date_done,
       CASE WHEN p.id IS NULL THEN 'missing' ELSE 'ok' END AS project_status,
       {EPOCH.format('t.date_done')} - {EPOCH.format('j.issued_at')} AS duration_s
FROM job j LEFT JOIN project p ON p.id = j.project_id LEFT JOIN taskmeta t ON t.task_id = j.task_id"""


@query("job_durations", oracle=with_roles(JOB_DURATIONS_SQL, "job", "project", "taskmeta"))
def q_job_durations(spark, sf):
    r = Roles(spark, sf)
    return jobs.job_durations(r.job, r.project, r.taskmeta)


QUEUE_SQL = """
SELECT j.id, j.queue, coalesce(s.n, 0) AS n_subscribers, coalesce(s.n, 0) > 0 AS routed
FROM job j LEFT JOIN (SELECT q AS queue, count(*) AS n FROM
                        (SELECT unnest(string_split(queues, ',')) AS q FROM host) GROUP BY q) s ON s.queue = j.queue"""


@query("queue_routing", oracle=with_roles(QUEUE_SQL, "job", "host"))
def q_queue_routing(spark, sf):
    r = Roles(spark, sf)
    return queue_routing(r.job.select("id", "queue"), r.host)


LOG_SPLIT_SQL = """
SELECT id, job_id, logtype, CASE WHEN logtype IN ('i', 'w', 'e', 'sb', 'se', 'jb', 'je') THEN 'append' ELSE 'reject' END AS route
FROM joblog"""


@query("log_reject_split", oracle=with_roles(LOG_SPLIT_SQL, "joblog"))
def q_log_reject_split(spark, sf):
    ok, bad = split_valid_log(Roles(spark, sf).joblog.select("id", "job_id", "logtype"))
    return ok.withColumn("route", F.lit("append")).unionByName(bad.withColumn("route", F.lit("reject")))


LOG_COUNTS_SQL = """
SELECT p.id AS job_id, coalesce(c.n_valid, 0) AS n_valid, coalesce(c.n_errors, 0) AS n_errors,
       coalesce(c.n_valid, 0) = 0 AS no_messages
FROM project p LEFT JOIN (
  SELECT job_id, count(*) AS n_valid, count(*) FILTER (WHERE logtype = 'e') AS n_errors
  FROM joblog WHERE logtype IN ('i', 'w', 'e', 'sb', 'se', 'jb', 'je') GROUP BY job_id) c ON c.job_id = p.id"""


@query("log_counts", oracle=with_roles(LOG_COUNTS_SQL, "joblog", "project"))
def q_log_counts(spark, sf):
    r = Roles(spark, sf)
    ok, _ = split_valid_log(r.joblog)
    counts = ok.groupBy("job_id").agg(F.count(F.lit(1)).alias("n_valid"),
                                      F.count(F.when(F.col("logtype") == "e", 1)).alias("n_errors"))
    expected = r.project.select(F.col("id").alias("job_id"))
    out = A.counts_with_zero(expected, counts, "job_id", ["n_valid", "n_errors"])
    return out.withColumn("no_messages", F.col("n_valid") == 0)


LATEST_FIVE_SQL = "SELECT id, ts, message FROM joblog ORDER BY ts DESC, id DESC LIMIT 5"


@query("latest_five", oracle=with_roles(LATEST_FIVE_SQL, "joblog"))
def q_latest_five(spark, sf):
    """T-5: the latest five entries (a top-k report: the limit is the feature)."""
    return Roles(spark, sf).joblog.select("id", "ts", "message").orderBy(F.desc("ts"), F.desc("id")).limit(5)


VOTES_SQL = "SELECT message AS choice, count(*) AS votes FROM joblog WHERE logtype = 'i' GROUP BY message"


@query("vote_counts", oracle=with_roles(VOTES_SQL, "joblog"))
def q_vote_counts(spark, sf):
    """A-13: votes per choice (a click row is one vote for its message)."""
    return (Roles(spark, sf).joblog.filter(F.col("logtype") == "i")
            .groupBy(F.col("message").alias("choice")).agg(F.count(F.lit(1)).alias("votes")))


JOB_REPORT_SQL = JOB_DURATIONS_SQL.replace("SELECT j.id", "SELECT * FROM (SELECT j.id", 1) + f""") b
LEFT JOIN (SELECT job_id AS id, count(*) AS n_steps_, count(*) FILTER (WHERE status = 'done') AS n_done_,
                  sum(duration_s) AS steps_duration_s,
                  arg_min(title, (begin_ts, begin_id)) FILTER (WHERE status = 'unfinished') AS failed_step
           FROM ({STEP_SPANS_SQL}) GROUP BY job_id) s USING (id)
LEFT JOIN (SELECT job_id AS id, count(*) FILTER (WHERE logtype = 'w') AS n_warnings_, count(*) FILTER (WHERE logtype = 'e') AS n_errors_
           FROM joblog GROUP BY job_id) l USING (id)"""


@query("job_report", oracle=with_roles(
    "SELECT * EXCLUDE (n_steps_, n_done_, n_warnings_, n_errors_), coalesce(n_steps_, 0) AS n_steps, coalesce(n_done_, 0) AS n_done, "
    "coalesce(n_warnings_, 0) AS n_warnings, coalesce(n_errors_, 0) AS n_errors FROM ("
    + JOB_REPORT_SQL + ")", "job", "project", "taskmeta", "joblog"))
def q_job_report(spark, sf):
    r = Roles(spark, sf)
    return jobs.job_report(r.job, r.project, r.taskmeta, r.joblog)
