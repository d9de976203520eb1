"""Host inventory: worker configs, processes, disks, health, proxy sites,
node metadata, installed bundles and free ports (S-8 .. S-12, S-17, X-7,
X-20 .. X-22, A-2 .. A-4, A-11, W-7, F-10, F-12, F-14, C-9).

Captured machine output (file listings, process tables, ``df`` reports,
site files) arrives as rows tagged with the host; each parser is a column
expression and each per-host summary a partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsframe.functions import naming
from opsframe.functions import text as T
from opsframe.operators import aggregates as A
from opsframe.operators.filters import PORT_CEILING, PORT_FLOOR, other_bundle, port_eligible

# ---- fixed values ----------------------------------------------------------
RESERVED_APP_DIRS = ("django",)
RESERVED_BUNDLE_DIRS = ("src",)
# ---------------------------------------------------------------------------


def active_bundles(listing: DataFrame, name: str = "name") -> DataFrame:
    """S-8 / X-7: worker config file names → (app_id, bundle_name, port);
    names that are not worker configs or have a non-integer port are skipped."""
    p = listing.withColumn("__w", naming.worker_conf_parts(name)).filter(F.col("__w").isNotNull())
    return p.select("*", "__w.*").drop("__w")


def other_bundles(installed: DataFrame, keep: DataFrame) -> DataFrame:
    """F-14: installed bundles of an app other than the one kept (name starts
    ``bundle_`` and differs). ``keep``: (app_id, keep_bundle)."""
    j = installed.join(keep, "app_id")
    return j.filter(other_bundle("bundle_name", "keep_bundle"))


def installed_bundles(paths: DataFrame, app: Column, path: str = "path") -> DataFrame:
    """S-9 / F-10: two-level tree <app>/<bundle>/...: distinct (app, bundle)
    directories, skipping hidden ones, ``django`` apps and ``src`` bundles."""
    first = F.element_at(F.split(path, "/"), 1)
    d = paths.filter(F.col(path).contains("/")).select(app.alias("app_id"), first.alias("bundle_name"))
    return (d.filter(~F.col("app_id").startswith(".") & ~F.col("app_id").isin(*RESERVED_APP_DIRS))
            .filter(~F.col("bundle_name").startswith(".") & ~F.col("bundle_name").isin(*RESERVED_BUNDLE_DIRS))
            .distinct())


def df_report(df_lines: DataFrame) -> DataFrame:
    """S-12 + U-4: keep the header (line 0) and ``/dev`` lines of each report
    (space, then inode), followed by one blank line per report (``part`` 1, after all lines of ``part`` 0)."""
    kept = df_lines.filter((F.col("line_no") == 0) | F.col("line").startswith("/dev"))
    blanks = df_lines.select("host", "type").distinct().select(
        "host", "type", F.lit(1).alias("part"), F.lit(None).cast(dict(df_lines.dtypes)["line_no"]).alias("line_no"), F.lit("").alias("line"))
    return kept.select("host", "type", F.lit(0).alias("part"), "line_no", "line").unionByName(blanks)


def max_disk(hosts: DataFrame, df_lines: DataFrame, host: str = "host") -> DataFrame:
    """A-3: per host the highest disk use; hosts with no candidate line get
    pct 0 and no type/detail (the reference's start value)."""
    best = A.max_disk(df_lines)
    return (hosts.select(host).join(best, host, "left")
            .withColumn("pct", F.coalesce("pct", F.lit(0))))


def fleet_health(hosts: DataFrame, df_lines: DataFrame, work_items: DataFrame, workers: DataFrame) -> DataFrame:
    """C-9 / A-11: one row per host: max disk, current load, active item
    count and worker count. ``hosts``: (host, loadavg_curr, uptime);
    ``work_items`` / ``workers``: one row per item / worker with its ``host``."""
    md = max_disk(hosts, df_lines)
    nt = work_items.groupBy("host").agg(F.count(F.lit(1)).alias("num_active_items"))
    nw = workers.groupBy("host").agg(F.count(F.lit(1)).alias("num_workers"))
    return (hosts.join(md, "host", "left").join(nt, "host", "left").join(nw, "host", "left")
            .fillna(0, ["num_active_items", "num_workers"]))


def site_files(site_lines: DataFrame) -> DataFrame:
    """S-10 / X-22: proxy site files → one row per site.

    ``site_lines``: (site, ord, text) where ``text`` may hold several lines.
    Each line is stripped, a trailing ``;`` dropped, and split on whitespace;
    lines with fewer than two tokens are ignored. ``server X`` (X not ``{``),
    ``alias`` (4th path part = bundle name) and ``server_name`` (the list of
    its names) are last-wins. An alias path with fewer
    than four parts is an ``error``. Sites starting with ``.`` are skipped.
    """
    ln = (site_lines.filter(~F.col("site").startswith("."))
          .select("site", "ord", F.posexplode(T.split_lines(F.col("text"))).alias("sub", "line")))
    ln = ln.withColumn("line", T.strip_ws(F.regexp_replace(T.strip_ws("line"), ";+$", ""))).filter(F.col("line").rlike(r"\s"))
    t = ln.select("site", F.struct("ord", "sub").alias("pos"), F.split("line", r"\s+").alias("t"))
    first, second = F.col("t")[0], F.col("t")[1]
    is_server = (first == "server") & (second != "{")
    is_alias, is_name = first == "alias", first == "server_name"
    # only what a line says goes into the sort of the aggregation, not the line's words
    said = t.select("site", "pos", F.when(is_server, second).alias("server"), F.when(is_name, F.expr("slice(t, 2, size(t))")).alias("server_name"),
                    is_alias.alias("is_alias"), F.when(is_alias, F.try_element_at(F.split(second, "/"), F.lit(4))).alias("bundle_name"))
    return said.groupBy("site").agg(
        F.max_by("server", F.when(F.col("server").isNotNull(), F.col("pos"))).alias("server"),
        F.max_by("server_name", F.when(F.col("server_name").isNotNull(), F.col("pos"))).alias("server_name"),
        F.max_by("bundle_name", F.when(F.col("is_alias"), F.col("pos"))).alias("bundle_name"),
        F.count(F.when(F.col("is_alias") & F.col("bundle_name").isNull(), 1)).alias("n_bad_alias"))


def node_meta(meta: DataFrame, hosts: DataFrame, fields=("instance_id", "name", "role")) -> DataFrame:
    """S-17: node metadata files (host, field, text) → one row per host with
    each field stripped; a missing field falls back to ``localhost`` (the
    host's own name for ``name``), as off-cloud."""
    p = (meta.withColumn("value", T.strip_ws("text")).groupBy("host")
         .pivot("field", list(fields)).agg(F.first("value")))
    out = hosts.select("host").join(p, "host", "left")
    for f in fields:
        fallback = F.col("host") if f == "name" else F.lit("localhost")
        out = out.withColumn(f, F.coalesce(F.col(f), fallback))
    return out


REQUEST_STEP = 4096


def free_ports(used: DataFrame, blocked: DataFrame, requests: DataFrame, floor: int = A.PORT_FLOOR) -> DataFrame:
    """W-7 + A-4 + F-12: allocate ``n_req`` ports per host.

    Start after the highest used port (at least after ``floor``, and never at
    1024 or below); skip blocked ports; never past 25000 (the reference can
    hand out 25001 — rejected here). Requests that do not fit get status
    ``out_of_ports``. ``used``/``blocked``: (host, port); ``requests``: (host,
    n_req). Output: (host, request_no, port, status).

    The free ports between two blocked ones are an interval: it serves the
    request numbers from the count of free ports before it. So a host is a
    handful of intervals (a window over its blocked ports, distinct and within
    the port range), and requests are counted out of intervals in steps of
    REQUEST_STEP, whatever ``n_req`` is.
    """
    maxu = A.max_used_port(used, "host", floor=floor)
    req = (requests.filter(F.col("n_req") > 0).join(maxu, "host", "left")
           .select("host", F.col("n_req").cast("bigint").alias("n_req"),
                   (F.greatest(F.coalesce("max_used_port", F.lit(floor)), F.lit(floor), F.lit(PORT_FLOOR - 1)) + 1).cast("bigint").alias("first")))
    blk = (blocked.select("host", F.col("port").cast("bigint").alias("port")).distinct().join(req, "host")
           .filter(F.col("port").between(F.col("first"), F.lit(PORT_CEILING))))
    by_port = Window.partitionBy("host").orderBy("port")
    after = blk.select("host", "n_req", (F.col("port") + 1).alias("begin"),
                       (F.col("port") - F.col("first") - F.row_number().over(by_port) + 1).alias("no"))
    gaps = req.select("host", "n_req", F.col("first").alias("begin"), F.lit(0).cast("bigint").alias("no")).unionByName(after)
    end = F.lead("no").over(Window.partitionBy("host").orderBy("begin"))
    room = F.greatest(F.lit(PORT_CEILING) - F.col("begin") + 1, F.lit(0))
    gaps = gaps.withColumn("end", end).withColumn("last", F.col("end").isNull()).withColumn("end", F.coalesce("end", F.col("no") + room))
    served = gaps.select("host", "begin", "no", (F.least("end", "n_req") - F.col("no")).alias("n"))
    unserved = gaps.filter("last").select("host", F.lit(None).cast("bigint").alias("begin"), F.col("end").alias("no"), (F.col("n_req") - F.col("end")).alias("n"))
    runs = served.unionByName(unserved).filter("n > 0")
    steps = runs.withColumn("from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(REQUEST_STEP).cast("bigint"))))
    steps = steps.repartition("host", "from")  # a host with very many requests is counted out by several tasks
    each = steps.withColumn("i", F.explode(F.sequence(F.col("from"), F.least(F.col("n") - 1, F.col("from") + REQUEST_STEP - 1))))
    port = (F.col("begin") + F.col("i")).cast("int")
    ok = F.coalesce(port_eligible(port), F.lit(False))
    return each.select("host", (F.col("no") + F.col("i")).alias("request_no"), F.when(ok, port).alias("port"),
                       F.when(ok, "ok").otherwise("out_of_ports").alias("status"))
