"""Job-log analysis (W-2 .. W-5, J-1, J-11, C-8) and the port registry.

The job log is append-only: (id, job_id, ts, message, logtype). Order inside a
job is (ts, id); ties on ts are broken by the lower id, as everywhere.
All order-dependent steps use the two-level scans of ``operators.windows``
with the hour of ``ts`` as bucket, so a job or port that owns a large share
of the rows is still spread over many partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsframe.functions.times import seconds_between
from opsframe.operators.filters import safe_identifier
from opsframe.operators.windows import running_count_before, step_of_message, step_spans


def time_bucket(ts: str = "ts") -> Column:
    """Slice of the two-level scans: the hour of ``ts`` (monotone in (ts, id)).
    A key that is hot within one day is still spread over up to 24 partitions per
    day, while the per-key slice table stays small (≤ 8,760 rows a year)."""
    return F.date_trunc("hour", F.col(ts))


def job_steps(joblog: DataFrame) -> DataFrame:
    """W-3: step spans with duration and done / unfinished status."""
    return step_spans(joblog, "job_id", "message", time_bucket())


def step_messages(joblog: DataFrame) -> DataFrame:
    """W-4 + C-8: per step: number of messages and of warnings/errors logged
    inside it (rows between its ``sb`` and the next marker)."""
    tagged = step_of_message(joblog, "job_id", time_bucket())
    inside = tagged.filter(F.col("step_begin_id").isNotNull() & ~F.col("logtype").isin("sb", "se"))
    return inside.groupBy("job_id", "step_begin_id", "step_title").agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.count(F.when(F.col("logtype") == "w", 1)).alias("n_warnings"),
        F.count(F.when(F.col("logtype") == "e", 1)).alias("n_errors"))


def job_report(job: DataFrame, project: DataFrame, taskmeta: DataFrame, joblog: DataFrame) -> DataFrame:
    """C-8 / J-1 / J-11 / S-20: one row per job: project found?, job duration, step counts, the
    seconds spent in finished steps, warnings and errors logged, first unfinished (failed) step."""
    steps = job_steps(joblog)
    per_job = steps.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("n_steps"),
        F.count(F.when(F.col("status") == "done", 1)).alias("n_done"),
        F.sum("duration_s").alias("steps_duration_s"),
        F.min_by("title", F.when(F.col("status") == "unfinished", F.struct("begin_ts", "begin_id"))).alias("failed_step"))
    logged = joblog.groupBy("job_id").agg(
        F.count(F.when(F.col("logtype") == "w", 1)).alias("n_warnings"), F.count(F.when(F.col("logtype") == "e", 1)).alias("n_errors"))
    base = job_durations(job, project, taskmeta)
    return (base.join(per_job.withColumnRenamed("job_id", "id"), "id", "left").join(logged.withColumnRenamed("job_id", "id"), "id", "left")
            .fillna(0, ["n_steps", "n_done", "n_warnings", "n_errors"]))


def job_durations(job: DataFrame, project: DataFrame, taskmeta: DataFrame) -> DataFrame:
    """J-1 + J-11: job → project must exist (status), job ⟕ task result on
    ``task_id``; duration = date_done − issued_at in seconds (null when the
    task has no result yet)."""
    p = project.select(F.col("id").alias("project_id"), F.lit(True).alias("__p"))
    t = taskmeta.select("task_id", "date_done")
    out = job.join(p, "project_id", "left").join(t, "task_id", "left")
    return out.select(
        "id", "project_id", "task_id", "jobcode", "issued_at", "date_done",
        F.when(F.col("__p").isNull(), F.lit("missing")).otherwise(F.lit("ok")).alias("project_status"),
        seconds_between("issued_at", "date_done").alias("duration_s"))


def port_outcomes(control: DataFrame) -> DataFrame:
    """W-5: outcome of every control command, replayed set-wide.

    Per port, commands in (ts, id) order. ``serve`` on a busy port is
    refused (``refused_busy``) before the name is checked; a badly named
    ``serve`` on a free port is ``refused_name`` and changes nothing;
    ``unserve`` of a free port is ``error_not_served``; everything else ``ok``.

    Island = number of earlier ``unserve`` rows on the port (every unserve
    frees the port). Within an island the first valid serve wins; it is the
    only ``ok`` serve and the port is busy after it.
    """
    c = control.withColumn("valid", (F.col("cmd") == "serve") & safe_identifier("bundle_name"))
    c = running_count_before(c, ["port"], ["ts", "id"], F.col("cmd") == "unserve", time_bucket(), "island")
    winners = (c.filter("valid").groupBy("port", "island")
               .agg(F.min(F.struct("ts", "id")).alias("w")))
    j = c.join(winners, ["port", "island"], "left")
    me = F.struct("ts", "id")
    outcome = (F.when(F.col("cmd") == "unserve",
                      F.when(F.col("w").isNotNull(), F.lit("ok")).otherwise(F.lit("error_not_served")))
               .when(F.col("w").isNull() | (me < F.col("w")), F.lit("refused_name"))
               .when(me == F.col("w"), F.lit("ok"))
               .otherwise(F.lit("refused_busy")))
    return j.select("id", "ts", "port", "cmd", "bundle_name", "island", outcome.alias("outcome"))


def port_registry(control: DataFrame) -> DataFrame:
    """W-5 live state: per port, the bundle served after the last command —
    the winner of the port's last island, if that island has one."""
    o = port_outcomes(control)
    # the open island is the one after the port's last unserve (number = all unserves)
    last = o.groupBy("port").agg(F.count(F.when(F.col("cmd") == "unserve", 1)).alias("island"))
    ok = o.filter((F.col("cmd") == "serve") & (F.col("outcome") == "ok"))
    return (ok.join(last, ["port", "island"], "left_semi")
            .select("port", "bundle_name", F.col("id").alias("since_id"), F.col("ts").alias("since_ts")))


def round_robin_workers(requests: DataFrame, workers: DataFrame, key: str = "project_id",
                        worker_id: str = "id", id_bucket: int = 1 << 20) -> DataFrame:
    """W-2 with the worker list: request k of a key goes to worker ``k mod n``
    of that key's workers (numbered by id), n = the key's worker count.

    Both numberings are two-level counts (requests by hour, workers by id
    range), so a key with very many requests or workers is spread over many
    partitions; the join is an equi-join on (key, worker number). Requests of a
    key without workers get no slot and no worker.
    """
    w = running_count_before(workers.select(key, worker_id), [key], [worker_id], F.lit(True),
                             F.floor(F.col(worker_id) / F.lit(id_bucket)), "worker_no")
    n = workers.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    r = running_count_before(requests, [key], ["ts", "id"], F.lit(True), time_bucket(), "__k")
    r = r.join(n, key, "left").withColumn("slot", (F.col("__k") % F.col("__n")).cast("int")).drop("__k", "__n")
    return (r.join(w.select(key, F.col("worker_no").cast("int").alias("slot"), F.col(worker_id).alias("worker_id")),
                   [key, "slot"], "left"))
