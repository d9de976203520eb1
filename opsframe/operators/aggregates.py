"""Aggregations (A-1 .. A-13). All are ``groupBy``/``agg`` with partial
(map-side) aggregation; lists are only built where the reference returns a
list and its length is bounded by construction (worker pids of one bundle,
upstreams of one app), otherwise results stay as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsframe.functions import text as T

PORT_FLOOR = 10000  # first port handed out is PORT_FLOOR + 1 (fixed value)


def counts_with_zero(expected: DataFrame, counts: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """A-1: counts for every expected key; missing keys count 0."""
    out = expected.join(counts, key, "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)).cast("bigint"))
    return out


def newest_by(df: DataFrame, key: str, value: Column, ts: str = "creation_date", tie: str = "id") -> DataFrame:
    """A-5: per key, ``value`` of the row with the newest ``ts``; ties go to the
    lowest ``tie`` id (the reference takes the first in database order)."""
    return df.groupBy(key).agg(F.max_by(value, F.struct(F.col(ts), -F.col(tie))).alias("newest"))


def max_used_port(ports: DataFrame, host: str, port: str = "port", floor: int = PORT_FLOOR) -> DataFrame:
    """A-4: per host the highest used port, never below the floor (10000)."""
    return ports.groupBy(host).agg(F.greatest(F.lit(floor), F.max(port)).alias("max_used_port"))


def proc_groups(procs: DataFrame) -> DataFrame:
    """A-2 + X-21: gunicorn process titles → one row per bundle.

    ``procs``: (host, pos, pid, user, command) where ``pos`` is the scan order
    of the process table. Port and user come from the first process seen,
    the master pid from the last master seen, worker pids sorted. The pid
    list per bundle is bounded by the bundle's worker count.
    """
    t = T.gunicorn_title(F.col("command"))
    p = procs.withColumn("t", t).filter(F.col("t").isNotNull())
    return p.groupBy("host", F.col("t.bundle_name").alias("bundle_name")).agg(
        F.min_by(F.col("t.port"), "pos").alias("port"),
        F.min_by(F.col("user"), "pos").alias("user"),
        F.max_by(F.when(F.col("t.kind") == "master", F.col("pid")),
                 F.when(F.col("t.kind") == "master", F.col("pos"))).alias("master_pid"),
        F.sort_array(F.collect_list(F.when(F.col("t.kind") == "worker", F.col("pid")))).alias("worker_pids"))


def max_disk(df_lines: DataFrame) -> DataFrame:
    """A-3 + X-20: per host, the disk line with the highest use percent.

    ``df_lines``: (host, type, line_no, line) where ``type`` is space or
    inode (space report first) and ``line_no`` 0 is the header. Only lines
    starting ``/dev`` or ``.host`` count; the last-but-one token must end in
    ``%``. Strictly greater wins, so the *first* maximum in report order wins,
    and 0 % never wins (the start value is 0). Detail = header + line.
    """
    order = F.when(F.col("type") == "space", 0).otherwise(1)
    headers = df_lines.filter(F.col("line_no") == 0).select("host", "type", F.col("line").alias("header"))
    cand = (df_lines.filter(F.col("line").startswith("/dev") | F.col("line").startswith(".host"))
            .withColumn("__toks", F.split(T.strip_ws("line"), r"\s+"))
            .withColumn("pct", T.percent_value(F.try_element_at("__toks", F.lit(-2))))
            .filter(F.col("pct") > 0)
            .join(headers, ["host", "type"], "left"))
    best = cand.groupBy("host").agg(F.max_by(
        F.struct("pct", "type", F.concat_ws("\n", "header", "line").alias("detail")),
        F.struct(F.col("pct"), -order.alias("o"), -F.col("line_no"))).alias("m"))
    return best.select("host", F.col("m.pct").alias("pct"), F.col("m.type").alias("type"),
                       F.col("m.detail").alias("detail"))


def last_wins_map(entries: DataFrame, key_cols: list[str], k: str, v: str, pos: str) -> DataFrame:
    """A-9: last value per (key, k) in ``pos`` order, as rows (k, v, first pos)."""
    return entries.groupBy(*key_cols, k).agg(F.max_by(v, pos).alias(v), F.min(pos).alias(pos))

