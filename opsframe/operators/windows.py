"""Order-dependent operators (W-1 .. W-8, T-1, T-2, T-6) as windows and
two-level scans.

Hot keys: one port, job or log may own a third of all rows. A plain window
partitioned by that key puts all of its rows into one task. The running
counts here therefore use a *two-level scan*: rows are cut into (key, bucket)
slices, each slice is scanned locally, and slice totals (one row per slice)
give the offsets. Only the slice-total table is windowed per key, and it is
small (buckets per key), so the big data never sits in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsframe.functions.times import seconds_between
from opsframe.session import cut_lineage


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def running_count_before(df: DataFrame, keys: list[str], order: list[str], flag: Column | str,
                         bucket: Column | str, out: str = "n_before") -> DataFrame:
    """Number of earlier rows (by ``order`` within ``keys``) where ``flag`` is true.

    Two-level scan: ``bucket`` must be monotone in ``order`` (e.g. the day of
    ``ts`` when ordering by (ts, id)). Within (keys, bucket) a local exclusive
    running sum; across buckets an offset from the per-bucket totals.
    """
    flag_c = F.col(flag) if isinstance(flag, str) else flag
    bucket_c = F.col(bucket) if isinstance(bucket, str) else bucket
    d = df.withColumn("__b", bucket_c).withColumn("__f", flag_c.cast("int"))
    local_w = (Window.partitionBy(*keys, "__b").orderBy(*_cols(order))
               .rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("__local", F.coalesce(F.sum("__f").over(local_w), F.lit(0)))
    totals = d.groupBy(*keys, "__b").agg(F.sum("__f").alias("__tot"))
    off_w = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("__off", F.coalesce(F.sum("__tot").over(off_w), F.lit(0))).drop("__tot")
    return (d.join(offsets, [*keys, "__b"], "left")
            .withColumn(out, (F.col("__local") + F.col("__off")).cast("bigint"))
            .drop("__b", "__f", "__local", "__off"))


def dense_index(df: DataFrame, order: list[str], out: str = "idx", buckets: int | None = None,
                start: Column | int = 0) -> DataFrame:
    """W-8: consecutive 0-based (plus ``start``) index in ``order`` without a
    global (single-task) window.

    One pass over the input: rows are range-partitioned by the *full* sort key
    (so ties on a leading column still spread), sorted inside their partition
    and numbered there (``monotonically_increasing_id`` is the partition number
    and the row's place in it). The result is written once to the reliable
    checkpoint, which fixes the numbering for every branch of the plan and for
    recomputation after a lost executor. Counts per partition - one row per
    partition, a proven size bound - become offsets, joined by broadcast.
    """
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = _cols(order)
    placed = cut_lineage(df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
                         .withColumn("__at", F.monotonically_increasing_id()))
    numbered = (placed.withColumn("__bk", F.shiftright("__at", 33))
                .withColumn("__row", F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))))
    counts = numbered.groupBy("__bk").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0))).drop("__n")
    start_c = start if isinstance(start, Column) else F.lit(start)
    return (numbered.join(F.broadcast(offsets), "__bk")
            .withColumn(out, (F.col("__off") + F.col("__row") + start_c).cast("bigint"))
            .drop("__at", "__bk", "__row", "__off"))


def keyed_index(df: DataFrame, keys: list[str], order: list[str], out: str = "idx", partitions: int | None = None) -> DataFrame:
    """J-7 / T-2: consecutive 0-based index in ``order`` within ``keys``, without a
    window over all rows of a key. ``order`` decides ties.

    Rows are range-partitioned by (keys, order) and checkpointed, which fixes the
    partition of each row; a slice is what one partition holds of a key. Rows are
    numbered inside their slice; a range boundary cuts at most one key, so fewer
    slices than there are partitions have earlier slices of their key, and their
    offsets are small enough to be joined by broadcast."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(df.repartitionByRange(n, *_cols(keys), *_cols(order)).withColumn("__bk", F.spark_partition_id()))
    counts = placed.groupBy(*keys, "__bk").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*keys).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)  # one row a slice
    offsets = counts.withColumn("__off", F.sum("__n").over(earlier)).filter(F.col("__off").isNotNull()).drop("__n")
    inside = F.row_number().over(Window.partitionBy(*keys, "__bk").orderBy(*_cols(order))) - 1
    numbered = placed.withColumn("__row", inside)
    offsets = offsets.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__bk").alias("__obk"), "__off")
    on = F.col("__bk") == F.col("__obk")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return (numbered.join(F.broadcast(offsets), on, "left")
            .withColumn(out, (F.col("__row") + F.coalesce("__off", F.lit(0))).cast("bigint"))
            .select(*df.columns, out))


def top_n_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, rank_col: str = "rn") -> DataFrame:
    """T-1 / W-6: keep the first ``n`` rows per key in ``order``.

    ``row_number() <= n`` directly above the window lets Spark plan a
    WindowGroupLimit, which prunes each partition to ``n`` rows per key before
    the shuffle — a hot key ships at most ``n`` rows per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def tail_lines(lines: DataFrame, keys: list[str], order: list[Column], n: int = 100) -> DataFrame:
    """T-1: the last ``n`` lines of every log; ``from_end`` = 1 for the last
    line. File order is the ascending ``order`` (re-sort on read)."""
    return top_n_per_key(lines, keys, [c.desc() for c in order], n, "from_end")


def next_row(df: DataFrame, keys: list[str], order: list[str], value: Column, bucket: Column,
             out: str = "next") -> DataFrame:
    """``lead(value)`` within ``keys`` in ``order``, as a two-level scan.

    Local lead inside (keys, bucket); the last row of a bucket takes the first
    value of the next non-empty bucket of the same key, found by a lead over
    the per-bucket first rows (one row per bucket).
    """
    d = df.withColumn("__b", bucket).withColumn("__v", value)
    ordkey = F.struct(*_cols(order))
    local = d.withColumn("__local", F.lead("__v").over(Window.partitionBy(*keys, "__b").orderBy(*_cols(order))))
    firsts = d.groupBy(*keys, "__b").agg(F.min_by("__v", ordkey).alias("__first"))
    nxt = firsts.withColumn("__nb", F.lead("__first").over(Window.partitionBy(*keys).orderBy("__b"))).drop("__first")
    return (local.join(nxt, [*keys, "__b"], "left")
            .withColumn(out, F.coalesce("__local", "__nb")).drop("__b", "__v", "__local", "__nb"))


def last_until(df: DataFrame, keys: list[str], order: list[str], value: Column, bucket: Column,
               out: str = "last") -> DataFrame:
    """Running ``last(value, ignorenulls)`` up to and including each row, as a
    two-level scan (local running last per (keys, bucket), else the last
    non-null value of the nearest earlier bucket)."""
    d = df.withColumn("__b", bucket).withColumn("__v", value)
    ordkey = F.struct(*_cols(order))
    w = Window.partitionBy(*keys, "__b").orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, 0)
    local = d.withColumn("__local", F.last("__v", ignorenulls=True).over(w))
    # one row per (key, bucket): its own last non-null value (or null)
    lasts = d.groupBy(*keys, "__b").agg(F.max_by("__v", F.when(F.col("__v").isNotNull(), ordkey)).alias("__lastv"))
    carry_w = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    prev = lasts.withColumn("__prev", F.last("__lastv", ignorenulls=True).over(carry_w)).drop("__lastv")
    return (local.join(prev, [*keys, "__b"], "left")
            .withColumn(out, F.coalesce("__local", "__prev")).drop("__b", "__v", "__local", "__prev"))


def step_spans(log: DataFrame, job: str = "job_id", title: str = "message", bucket: Column | None = None) -> DataFrame:
    """W-3: each ``sb`` row closes at the next row of the same (job, title) if
    that row is an ``se``; otherwise the step is ``unfinished`` (the runner
    never writes ``se`` when a step raises).

    Output: job_id, title, begin_id, begin_ts, end_id, end_ts, status, duration_s.
    """
    b = bucket if bucket is not None else F.date_trunc("hour", F.col("ts"))
    steps = log.filter(F.col("logtype").isin("sb", "se"))
    nxt = next_row(steps, [job, title], ["ts", "id"],
                   F.struct(F.col("logtype").alias("t"), F.col("ts").alias("ts"), F.col("id").alias("id")), b, "__n")
    nxt = nxt.filter(F.col("logtype") == "sb")
    closed = F.coalesce(F.col("__n.t") == "se", F.lit(False))
    return nxt.select(
        F.col(job).alias("job_id"), F.col(title).alias("title"),
        F.col("id").alias("begin_id"), F.col("ts").alias("begin_ts"),
        F.when(closed, F.col("__n.id")).alias("end_id"), F.when(closed, F.col("__n.ts")).alias("end_ts"),
        F.when(closed, F.lit("done")).otherwise(F.lit("unfinished")).alias("status"),
        F.when(closed, seconds_between(F.col("ts"), F.col("__n.ts"))).alias("duration_s"))


def step_of_message(log: DataFrame, job: str = "job_id", bucket: Column | None = None) -> DataFrame:
    """W-4: the step each row belongs to: the last step marker (``sb``/``se``)
    at or before the row within its job; marker ``sb`` → that step (begin id,
    title), ``se`` or none → null (between steps)."""
    b = bucket if bucket is not None else F.date_trunc("hour", F.col("ts"))
    marker = F.when(F.col("logtype").isin("sb", "se"), F.struct(F.col("logtype").alias("t"), F.col("id").alias("i"),
                                                                  F.col("message").alias("m")))
    out = last_until(log, [job], ["ts", "id"], marker, b, "__m")
    return (out.withColumn("step_begin_id", F.when(F.col("__m.t") == "sb", F.col("__m.i")))
            .withColumn("step_title", F.when(F.col("__m.t") == "sb", F.col("__m.m")))
            .drop("__m"))


def primary_until_first_hit(df: DataFrame, key: str, order: list[str], hit: str, out: str = "is_primary") -> DataFrame:
    """W-1: true for every row up to and including the first row with ``hit``
    (in ``order`` within ``key``); false afterwards. The first hit is a minimum
    per key, one row, joined back; no key's rows meet in one window."""
    firsts = df.filter(hit).groupBy(key).agg(F.min(F.struct(*order)).alias("__first"))
    return (df.join(firsts, key, "left")
            .withColumn(out, F.col("__first").isNull() | (F.struct(*order) <= F.col("__first"))).drop("__first"))
