"""Log catalog and log pages (S-6, S-19, U-2, W-6, X-8, X-9, J-13, F-15, A-10, T-1, T-6, C-7).

Listing rows: (hostname, name, filesize, mod_time). Every host lists its own
log folder; the union of all hosts' listings (U-2) is simply one DataFrame
with a ``hostname`` column, so "broadcast and gather" becomes one scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.functions import naming
from opsframe.operators.windows import tail_lines

PAGE_LINES = 100  # default page size (fixed value)


def supervisor_logs(listing: DataFrame) -> DataFrame:
    """X-8: keep supervisor log files, with (app_id, stream) from the name."""
    return (listing.filter(F.col("name").rlike(naming.SUPERVISOR_LOG_RE))
            .withColumn("app_id", naming.supervisor_log_app("name"))
            .withColumn("stream", naming.supervisor_log_stream("name")))


def latest_per_stream(listing: DataFrame, keys: tuple[str, ...] = ("hostname",)) -> DataFrame:
    """W-6: per (host, app, stream) the lexicographically last file name.
    A ``max_by``-free form (``max(name)``) — partial aggregation per key."""
    logs = supervisor_logs(listing)
    newest = logs.groupBy(*keys, "app_id", "stream").agg(F.max("name").alias("log_id"))
    return newest.join(logs.withColumnRenamed("name", "log_id"), [*keys, "app_id", "stream", "log_id"])


def log_catalog(listing: DataFrame, access_logs: DataFrame | None = None) -> DataFrame:
    """C-7 / S-19 / U-2 / X-9: every host's available logs for every app:
    newest stderr, newest stdout (+ the access log when listed) with caption,
    size, mod_time and ``mod_dt`` (UTC)."""
    sup = latest_per_stream(listing)
    out = sup.select("hostname", "app_id", "stream", "log_id", "filesize", "mod_time")
    if access_logs is not None:
        out = out.unionByName(access_logs.select("hostname", "app_id", F.lit("access").alias("stream"),
                                                 F.col("name").alias("log_id"), "filesize", "mod_time"))
    return (out.withColumn("caption", naming.log_caption("stream"))
            .withColumn("mod_dt", F.timestamp_add("MICROSECOND", (F.col("mod_time") * F.lit(1e6)).cast("bigint"),
                                                  F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))))


ACCESS_LOG_RE = r"^(.*)\.access\.log$"


def catalog_of_listing(listing: DataFrame) -> DataFrame:
    """C-7 / S-6: ``log_catalog`` of a listing (hostname, name, filesize, mod_time) that
    holds the apps' access logs (``<app>.access.log``) beside the supervisor logs."""
    access = listing.filter(F.col("name").rlike(ACCESS_LOG_RE)).withColumn("app_id", F.regexp_extract("name", ACCESS_LOG_RE, 1))
    return log_catalog(listing, access)


def log_page(lines: DataFrame, catalog: DataFrame, requests: DataFrame, n: int = PAGE_LINES, order: tuple[str, ...] = ("line_no",)) -> DataFrame:
    """F-15 + A-10 + T-1 + T-6: answer page requests (hostname, app_id, log_id).

    A request is allowed only if the log is in that app's catalog on that
    host (left-semi); otherwise status ``unavailable`` and an empty page. The
    page is the last ``n`` lines in file order, newline-joined — the list is
    bounded by ``n`` and pruned per key before the shuffle (WindowGroupLimit).
    ``lines``: (hostname, log_id, line) and the columns of ``order``, file order.
    """
    keys = ["hostname", "app_id", "log_id"]
    allowed = requests.join(catalog.select(*keys).distinct(), keys, "left_semi")
    denied = requests.join(catalog.select(*keys).distinct(), keys, "left_anti")
    last = tail_lines(lines.join(allowed.select("hostname", "log_id").distinct(), ["hostname", "log_id"], "left_semi"),
                      ["hostname", "log_id"], [F.col(c) for c in order], n)
    pages = last.groupBy("hostname", "log_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, "line"))), lambda x: x["line"]),
                     "\n").alias("page"),
        F.count(F.lit(1)).alias("n_lines"))
    ok = (allowed.join(pages, ["hostname", "log_id"], "left")
          .withColumn("page", F.coalesce("page", F.lit("")))          # T-6: no reply → ""
          .withColumn("n_lines", F.coalesce("n_lines", F.lit(0)))
          .withColumn("status", F.lit("ok")))
    bad = denied.select(*requests.columns).withColumn("page", F.lit("")).withColumn("n_lines", F.lit(0).cast("bigint")) \
        .withColumn("status", F.lit("unavailable"))
    return ok.unionByName(bad)


def first_nonempty_reply(replies: DataFrame, key: str, value: str = "reply", pos: str = "pos") -> DataFrame:
    """T-6: per request the first non-empty reply in host order, else ``""``."""
    nonempty = F.when(F.coalesce(F.length(value), F.lit(0)) > 0, F.col(pos))
    return replies.groupBy(key).agg(F.coalesce(F.min_by(value, nonempty), F.lit("")).alias("result"))


def log_service_status(listing: DataFrame, apps: DataFrame) -> DataFrame:
    """S-19: per requested app: ``ok`` (with log and host counts), ``no_logs``
    (hosts answered, none holds a log of the app) or, when no host answered
    at all, ``service_not_available`` — a flag, not an empty list."""
    from opsframe.operators.joins import scalar

    answered = (scalar(listing.select(F.lit(1)).limit(1).agg(F.count(F.lit(1)))) or 0) > 0
    per = supervisor_logs(listing).groupBy("app_id").agg(
        F.count(F.lit(1)).alias("n_logs"), F.count_distinct("hostname").alias("n_hosts"))
    out = apps.select("app_id").distinct().join(per, "app_id", "left").fillna(0, ["n_logs", "n_hosts"])
    status = (F.lit("service_not_available") if not answered
              else F.when(F.col("n_logs") > 0, F.lit("ok")).otherwise(F.lit("no_logs")))
    return out.withColumn("status", status)
