"""Driver queries: log files written as text, listed, and read back in splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsframe.operators.windows import tail_lines
from opsframe.plans import logs
from opsframe.registry import query
from opsframe.session import new_folder
from opsframe.sources import files
from opsframe.sources.roles import Roles, with_roles

KEYS = ["hostname", "log_id"]

# Each host's logs: documents dealt over an app's standard error and output of two releases and its access log.
NUMBER = "CAST(floor(log_id / 20) AS BIGINT)"
LOG_NAME = f"""CASE WHEN {NUMBER} % 5 = 4 THEN coalesce(app_id, 'none') || '.access.log'
ELSE 'bundle_' || coalesce(app_id, 'none') || '_2012-03-0' || CAST(1 + {NUMBER} % 2 AS STRING) || '-07.15.00-'
     || CASE WHEN {NUMBER} % 5 < 2 THEN 'stderr' ELSE 'stdout' END || '---supervisor-k3.log' END"""

FILE_CTES = f"""
fl AS (SELECT coalesce(hostname, 'none') AS hostname, coalesce(app_id, 'none') AS app_id, {LOG_NAME.replace('STRING', 'VARCHAR')} AS name,
              log_id AS doc_id, line_no, line FROM logline),
sizes AS (SELECT hostname, app_id, name, sum(strlen(line) + 1)::BIGINT AS filesize,
                 CASE WHEN name LIKE '%stderr%' THEN 'stderr' WHEN name LIKE '%stdout%' THEN 'stdout' ELSE 'access' END AS stream FROM fl GROUP BY ALL),
cat AS (SELECT hostname, app_id, stream, max(name) AS log_id FROM sizes GROUP BY ALL),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hostname, name ORDER BY doc_id DESC, line_no DESC) AS from_end FROM fl)
         WHERE from_end <= 100)"""


def written_logs(spark, sf):
    """The log files of every host, written in (document, line) order; their folder."""
    lines = Roles(spark, sf).logline.select(
        F.coalesce("hostname", F.lit("none")).alias("hostname"), F.expr(LOG_NAME).alias("name"), F.col("log_id").alias("doc_id"), "line_no", "line")
    path = new_folder(spark, "logs")
    files.write_ordered_text(lines.withColumnRenamed("name", "log_id"), path, KEYS, ["doc_id", "line_no"])
    return path


def listed_logs(spark, path):
    return files.list_ordered_text(spark, path, KEYS).withColumnRenamed("log_id", "name")


@query("tail_files", oracle=with_roles("SELECT hostname, name AS log_id, CAST(from_end AS INTEGER) AS from_end, line FROM last", "logline", extra=FILE_CTES))
def q_tail_files(spark, sf):
    """S-7 / T-1: last 100 lines of every log file, read as text in splits; each split is pruned to 100 lines a log before the shuffle."""
    lines = files.read_ordered_text(spark, written_logs(spark, sf), KEYS)
    t = tail_lines(lines, KEYS, [F.col(c) for c in files.FILE_ORDER], logs.PAGE_LINES)
    return t.select(*KEYS, F.col("from_end").cast("int").alias("from_end"), "line")


@query("file_catalog", oracle=with_roles(
    """SELECT c.*, s.filesize, CASE c.stream WHEN 'stderr' THEN 'Application Standard Error' WHEN 'stdout' THEN 'Application Standard Output'
                                             ELSE 'Web Server Access Log' END AS caption
       FROM cat c JOIN sizes s ON s.hostname = c.hostname AND s.name = c.log_id""", "logline", extra=FILE_CTES))
def q_file_catalog(spark, sf):
    """S-6 / C-7: every host's available logs with their sizes, from the metadata of the files (access logs too)."""
    cat = logs.catalog_of_listing(listed_logs(spark, written_logs(spark, sf)))
    return cat.select("hostname", "app_id", "stream", "log_id", "filesize", "caption")


@query("log_pages", oracle=with_roles(
    """SELECT q.hostname, q.app_id, q.log_id, CASE WHEN c.log_id IS NULL THEN 'unavailable' ELSE 'ok' END AS status,
              CASE WHEN c.log_id IS NULL THEN 0 ELSE p.n END AS n_lines, CASE WHEN c.log_id IS NULL THEN '' ELSE p.page END AS page
       FROM (SELECT hostname, app_id, name AS log_id FROM sizes UNION ALL SELECT DISTINCT hostname, app_id, 'other.access.log' FROM sizes) q
       LEFT JOIN cat c ON c.hostname = q.hostname AND c.app_id = q.app_id AND c.log_id = q.log_id
       LEFT JOIN (SELECT hostname, name, count(*) AS n, string_agg(line, chr(10) ORDER BY from_end DESC) AS page FROM last GROUP BY 1, 2) p
         ON p.hostname = q.hostname AND p.name = q.log_id""", "logline", extra=FILE_CTES))
def q_log_pages(spark, sf):
    """C-7 / F-15 / A-10 / T-6: a page of every log on every host: the newest of an app and stream and the access
    logs are in the catalog of the files; older ones and other apps' logs are refused. Only allowed files are read."""
    path = written_logs(spark, sf)
    listing = listed_logs(spark, path)
    catalog = logs.catalog_of_listing(listing)
    app = F.coalesce(F.nullif(F.regexp_extract("name", logs.ACCESS_LOG_RE, 1), F.lit("")), F.regexp_extract("name", "^bundle_(.*)_[^_]*$", 1))
    known = listing.select("hostname", app.alias("app_id"), F.col("name").alias("log_id"))
    asked = known.unionByName(known.select("hostname", "app_id").distinct().withColumn("log_id", F.lit("other.access.log")))
    page = logs.log_page(files.read_ordered_text(spark, path, KEYS), catalog, asked, order=tuple(files.FILE_ORDER))
    return page.select("hostname", "app_id", "log_id", "status", "n_lines", "page")
