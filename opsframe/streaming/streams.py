"""Structured Streaming forms (ST-1 .. ST-5).

Sources are file streams over the tables' parquet files or folders, with a rate
limit per micro-batch; sinks are parquet folders (never the driver-side memory
sink). Checkpoint and sink folders live under the session's checkpoint folder -
the shared folder the cluster names - so a restarted query resumes where it
stopped. ``run_available_now`` drains everything currently available and stops
(the batch-twin tests and the driver queries use it); a long-running deployment
calls ``.start()`` with a processing-time trigger instead.

ST-1 to ST-4 keep their state as a table beside the sink: batch N reads the
state that batch N-1 left, applies the batch operators of this library to it
and the new rows (two-level scans, so a hot log, job or port is spread over
partitions), and overwrites its own output and state folders, so a retried
batch is idempotent. Two state folders take turns - a batch reads one and
overwrites the other - so the state on disk is two copies however many batches
there are; only the output has a folder a batch. ST-3 and ST-4 depend on the order of time: rows
are held in the state until the watermark (greatest time seen less ``delay``)
has passed them, so the result doesn't depend on how rows fall into batches.
Rows behind the watermark go to a ``late`` folder, none is dropped. ``finish``
settles what is held after the last batch of a drained source.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.operators.filters import VALID_LOG_TYPES
from opsframe.operators.windows import next_row, tail_lines
from opsframe.plans.jobs import port_outcomes, port_registry, time_bucket
from opsframe.session import ensure_checkpoint_dir


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None,
                 max_bytes_per_trigger: int = 1 << 30) -> DataFrame:
    """A table as a streaming source with the table's schema: one parquet file,
    or a folder of them (the pattern names both). A micro-batch takes at most
    ``max_bytes_per_trigger`` of files, or ``max_files_per_trigger`` files."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    else:
        r = r.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return r.parquet(f"{path[:-1]}[t]")


def stream_dirs(spark: SparkSession, name: str) -> tuple[str, str]:
    """(sink folder, checkpoint folder) of one run, under the shared checkpoint dir."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:12]}"
    return f"{base}/sink", f"{base}/checkpoint"


def run_available_now(writer) -> None:
    """Drain what is available, however long it takes; a failed query raises."""
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


# ---- state tables -----------------------------------------------------------

def _state(spark: SparkSession, sink: str, name: str, batch: int | None, schema: str) -> DataFrame:
    """What batch ``batch`` left; empty before the first one. Only the last two batches' states are kept."""
    if batch is None or batch < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{sink}/state/{name}/turn={batch % 2}")


def _keep(df: DataFrame, sink: str, name: str, batch: int) -> None:
    """State after a batch, over that of the batch before the last."""
    df.write.mode("overwrite").parquet(f"{sink}/state/{name}/turn={batch % 2}")


def _put(df: DataFrame, sink: str, name: str, batch: int | str) -> None:
    """Output of a batch."""
    df.write.mode("overwrite").parquet(f"{sink}/{name}/batch={batch}")


def run_with_state(rows: DataFrame, sink: str, checkpoint: str, step: Callable[[DataFrame, int], None]) -> int | None:
    """Drain ``rows`` through ``step(batch rows, batch id)``; the last batch id (None without batches)."""
    last: list[int] = []

    def each(df: DataFrame, batch: int) -> None:
        step(df, batch)
        last[:] = [batch]

    run_available_now(rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint))
    return last[0] if last else None


# ---- ST-2: rolling last-N lines per log ------------------------------------

TAIL_SCHEMA = "log_id bigint, line_no int, line string"


def rolling_tail(lines: DataFrame, sink: str, checkpoint: str, n: int = 100) -> DataFrame:
    """ST-2: per log the last ``n`` lines seen so far (by line number). The state
    is that tail; each batch keeps the last ``n`` of it and the new lines, which
    prunes every partition to ``n`` lines per log before the shuffle."""
    spark = lines.sparkSession

    def step(df: DataFrame, batch: int) -> None:
        new = df.select("log_id", F.col("line_no").cast("int").alias("line_no"), "line")
        both = _state(spark, sink, "tail", batch - 1, TAIL_SCHEMA).unionByName(new)
        _keep(tail_lines(both, ["log_id"], [F.col("line_no")], n).drop("from_end"), sink, "tail", batch)

    return _state(spark, sink, "tail", run_with_state(lines, sink, checkpoint, step), TAIL_SCHEMA)


# ---- rows held until the watermark -----------------------------------------

def _marks(spark: SparkSession, df: DataFrame, sink: str, batch: int, delay: str) -> tuple[Column, Column]:
    """(watermark of earlier batches, watermark with this one): the greatest time seen less ``delay``.

    Two single values are read: the greatest time of earlier batches (kept in the state) and of this one."""
    before = _state(spark, sink, "seen", batch - 1, "ts timestamp_ntz").agg(F.max("ts")).first()[0]
    now = df.agg(F.max("ts")).first()[0]
    top = max([x for x in (before, now) if x is not None], default=None)
    _keep(spark.createDataFrame([(top,)] if top is not None else [], "ts timestamp_ntz"), sink, "seen", batch)
    mark = lambda t: F.lit(t).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}")
    return mark(before), mark(top)


def _held(spark: SparkSession, df: DataFrame, sink: str, batch: int, schema: str, delay: str) -> tuple[DataFrame, Column, Column]:
    """(held rows and the batch's rows in time, old watermark, new watermark) of an ordered operator.
    Rows behind the old watermark are written to ``late``."""
    old, new = _marks(spark, df, sink, batch, delay)
    late = F.coalesce(F.col("ts") <= old, F.lit(False))
    columns = [x.split()[0] for x in schema.split(", ")]
    rows = df.select(columns)
    _put(rows.filter(late), sink, "late", batch)
    return _state(spark, sink, "held", batch - 1, schema).unionByName(rows.filter(~late)), old, new


# ---- ST-1: validated job-log ingest ----------------------------------------

LOG_SCHEMA = "id bigint, job_id bigint, ts timestamp_ntz, message string, logtype string"
SEEN_SCHEMA = "id bigint, ts timestamp_ntz"


def ingest_job_log(log: DataFrame, sink: str, checkpoint: str, delay: str = "1 hour") -> None:
    """ST-1: every row of the feed goes to one of three outputs: valid log types to
    ``append``, others to ``reject``, rows behind the watermark to ``late`` (S-2
    appends or refuses a row, it never loses one). A row whose id came before -
    a repeated delivery - is left out: of the rows of one id in a batch the
    earliest counts, and ids are remembered until the watermark is ``delay`` past
    their time. Rows without a time are never late."""
    spark = log.sparkSession
    valid = F.coalesce(F.col("logtype").isin(list(VALID_LOG_TYPES)), F.lit(False))
    columns = [c.split()[0] for c in LOG_SCHEMA.split(", ")]
    rows = log.withColumn("ts", F.col("ts").cast("timestamp_ntz")).select(*columns)

    def step(df: DataFrame, batch: int) -> None:
        old, mark = _marks(spark, df, sink, batch, delay)
        late = F.coalesce(F.col("ts") <= old, F.lit(False))
        _put(df.filter(late), sink, "late", batch)
        first = F.min(F.struct("ts", *[c for c in columns if c not in ("id", "ts")])).alias("r")
        seen = _state(spark, sink, "ids", batch - 1, SEEN_SCHEMA)
        fresh = df.filter(~late).groupBy("id").agg(first).join(seen, "id", "left_anti").select("id", "r.*").select(*columns)
        _put(fresh.filter(valid), sink, "append", batch)
        _put(fresh.filter(~valid), sink, "reject", batch)
        known = seen.unionByName(df.filter(~late).groupBy("id").agg(F.min("ts").alias("ts"))).groupBy("id").agg(F.min("ts").alias("ts"))
        _keep(known.filter(F.coalesce(F.col("ts") + F.expr(f"INTERVAL {delay}") > mark, F.lit(True))), sink, "ids", batch)

    run_with_state(rows, sink, checkpoint, step)


# ---- ST-3: step-span pairing with time-out ---------------------------------

STEP_SCHEMA = "id bigint, job_id bigint, ts timestamp_ntz, title string, logtype string"
STEP_OUT = "job_id bigint, title string, begin_id bigint, begin_ts timestamp_ntz, end_id bigint, end_ts timestamp_ntz, status string"


def settle_steps(rows: DataFrame, mark: Column, timeout: str) -> tuple[DataFrame, DataFrame]:
    """(settled pairs, rows still open) of ``sb`` / ``se`` rows when all rows up to ``mark`` are known.

    An ``sb`` whose next row of (job, title) is an ``se`` within the time-out is ``done``; with
    another next row, or once the mark has passed its time-out, it is ``unfinished``. An ``se``
    that ends nothing is ``late_end``."""
    me = F.struct(F.col("logtype").alias("t"), F.col("ts").alias("ts"), F.col("id").alias("id"))
    d = next_row(rows, ["job_id", "title"], ["ts", "id"], me, time_bucket(), "nx")
    wait = F.expr(f"INTERVAL {timeout}")
    ends = (F.col("nx.t") == "se") & (F.col("nx.ts") <= F.col("ts") + wait)
    known = F.coalesce(F.col("nx.ts") <= mark, F.lit(False)) | F.coalesce(F.col("ts") + wait < mark, F.lit(False))
    begins = d.filter(F.col("logtype") == "sb")
    done = known & F.coalesce(ends, F.lit(False))
    pairs = begins.filter(known).select(
        "job_id", "title", F.col("id").alias("begin_id"), F.col("ts").alias("begin_ts"),
        F.when(done, F.col("nx.id")).alias("end_id"), F.when(done, F.col("nx.ts")).alias("end_ts"),
        F.when(done, F.lit("done")).otherwise(F.lit("unfinished")).alias("status"))
    # ends that a begin points to, settled or not
    taken = begins.filter(F.coalesce(ends, F.lit(False))).select(F.col("nx.id").alias("id"))
    alone = rows.filter((F.col("logtype") == "se") & (F.col("ts") <= mark)).join(taken, "id", "left_anti")
    late = alone.select("job_id", "title", F.lit(None).cast("bigint").alias("begin_id"), F.lit(None).cast("timestamp_ntz").alias("begin_ts"),
                        F.col("id").alias("end_id"), F.col("ts").alias("end_ts"), F.lit("late_end").alias("status"))
    still = begins.filter(~known).select("id", "job_id", "ts", "title", "logtype").unionByName(
        rows.filter((F.col("logtype") == "se") & (F.col("ts") > mark)).select("id", "job_id", "ts", "title", "logtype"))
    return pairs.unionByName(late), still


def step_pairs(log: DataFrame, sink: str, checkpoint: str, timeout: str = "1 hour", delay: str = "1 hour", finish: bool = True) -> DataFrame:
    """ST-3: pair each ``sb`` with the next ``se`` of the same (job, title), with a time-out.

    The state is what ``settle_steps`` left open: begins and ends that the watermark hasn't passed.
    ``finish`` settles them after the drain with the greatest time seen as the time that is:
    begins that are not yet past their time-out and have no next row stay unreported."""
    spark = log.sparkSession
    steps = log.filter(F.col("logtype").isin("sb", "se")).select(
        "id", "job_id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("message").alias("title"), "logtype")

    def step(df: DataFrame, batch: int) -> None:
        rows, _, mark = _held(spark, df, sink, batch, STEP_SCHEMA, delay)
        pairs, still = settle_steps(rows, mark, timeout)
        _put(pairs, sink, "pairs", batch)
        _keep(still, sink, "held", batch)

    last = run_with_state(steps, sink, checkpoint, step)
    if finish and last is not None:
        top = _state(spark, sink, "seen", last, "ts timestamp_ntz").agg(F.max("ts")).first()[0]
        pairs, _ = settle_steps(_state(spark, sink, "held", last, STEP_SCHEMA), F.lit(top).cast("timestamp_ntz"), timeout)
        _put(pairs, sink, "pairs", "finish")
    if last is None:
        return spark.createDataFrame([], STEP_OUT)
    return spark.read.schema(STEP_OUT).parquet(f"{sink}/pairs").drop("batch")


# ---- ST-4: live port registry ----------------------------------------------

PORT_SCHEMA = "id bigint, ts timestamp_ntz, port int, cmd string, bundle_name string"
SERVED_SCHEMA = "port int, bundle_name string, since_id bigint, since_ts timestamp_ntz"
PORT_OUT = "id bigint, ts timestamp_ntz, port int, cmd string, bundle_name string, outcome string"


def port_registry_stream(control: DataFrame, sink: str, checkpoint: str, delay: str = "1 hour", finish: bool = True) -> DataFrame:
    """ST-4: outcome of every control command, in (ts, id) order per port.

    The state is the bundle each port serves, and the commands that the watermark hasn't passed.
    What a port serves enters the batch operator (W-5) as the command that began it."""
    spark = control.sparkSession
    rows = control.select("id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("port").cast("int").alias("port"), "cmd", "bundle_name")

    def apply(known: DataFrame, batch: int, name: int | str) -> None:
        served = _state(spark, sink, "served", batch - 1, SERVED_SCHEMA)
        began = served.select(F.col("since_id").alias("id"), F.col("since_ts").alias("ts"), "port", F.lit("serve").alias("cmd"), "bundle_name")
        both = began.unionByName(known)
        out = port_outcomes(both).select("id", "ts", "port", "cmd", "bundle_name", "outcome")
        _put(out.join(began.select("port", "id", "cmd"), ["port", "id", "cmd"], "left_anti").select("id", "ts", "port", "cmd", "bundle_name", "outcome"), sink, "out", name)
        _keep(port_registry(both).select("port", "bundle_name", "since_id", "since_ts"), sink, "served", batch)

    def step(df: DataFrame, batch: int) -> None:
        held, _, mark = _held(spark, df, sink, batch, PORT_SCHEMA, delay)
        apply(held.filter(F.col("ts") <= mark), batch, batch)
        _keep(held.filter(~F.coalesce(F.col("ts") <= mark, F.lit(False))), sink, "held", batch)

    last = run_with_state(rows, sink, checkpoint, step)
    if last is None:
        return spark.createDataFrame([], PORT_OUT)
    if finish:
        apply(_state(spark, sink, "held", last, PORT_SCHEMA), last + 1, "finish")
    return spark.read.schema(PORT_OUT).parquet(f"{sink}/out").drop("batch")


# ---- ST-5: per-host health per tumbling window -----------------------------

def health_windows(metrics: DataFrame, width: str = "60 seconds", delay: str = "2 minutes") -> DataFrame:
    """ST-5: per host and ``width`` window: max disk use and mean load,
    emitted once the watermark (max event time − ``delay``) passes the
    window end (append mode). ``metrics``: (host, ts, pct, load) — load as an
    integer in hundredths, so the window mean does not depend on summation order."""
    m = metrics.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    agg = m.groupBy(F.window("ts", width), "host").agg(
        F.max("pct").alias("max_pct"), F.avg("load").alias("avg_load"), F.count(F.lit(1)).alias("n"))
    return agg.select("host", F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window.end").cast("timestamp_ntz").alias("window_end"), "max_pct",
                      F.round("avg_load", 4).alias("avg_load"), "n")
