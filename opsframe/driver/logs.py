"""Driver queries: log tails, log catalog, page access, and text reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsframe.functions import naming
from opsframe.functions import text as T
from opsframe.functions.times import epoch_micros
from opsframe.operators.windows import tail_lines
from opsframe.driver.inventory import WORKER_CONF_CTE
from opsframe.plans import logs
from opsframe.registry import query
from opsframe.sources.roles import Roles, with_roles

@query("tail_lines", oracle=with_roles(
    """SELECT log_id, CAST(line_no AS INTEGER) AS line_no, CAST(from_end AS INTEGER) AS from_end, line FROM (
         SELECT *, row_number() OVER (PARTITION BY log_id ORDER BY line_no DESC) AS from_end FROM logline)
       WHERE from_end <= 100""", "logline"))
def q_tail_lines(spark, sf):
    """T-1 / S-7: last 100 lines of every log (default page size)."""
    t = tail_lines(Roles(spark, sf).logline, ["log_id"], [F.col("line_no")], logs.PAGE_LINES)
    return t.select("log_id", "line_no", F.col("from_end").cast("int").alias("from_end"), "line")


TAIL_TURNS = 5


@query("tail_turns", oracle=with_roles(
    f"""SELECT log_id, line_no, CAST(from_end AS INTEGER) AS from_end, line FROM (
         SELECT *, row_number() OVER (PARTITION BY log_id ORDER BY line_no DESC) AS from_end FROM turnlog)
       WHERE from_end <= {TAIL_TURNS}""", "turnlog"))
def q_tail_turns(spark, sf):
    """T-1 over conversation turns (``tail -n 5`` of every conversation)."""
    t = tail_lines(Roles(spark, sf).turnlog, ["log_id"], [F.col("line_no")], TAIL_TURNS)
    return t.select("log_id", "line_no", F.col("from_end").cast("int").alias("from_end"), "line")


# the oracles take names apart in their own way
SUP_APP = "regexp_replace(split_part({0}, '---', 1), '^bundle_|_[^_]*$', '', 'g')"
SUP_STREAM = "string_split(split_part({0}, '---', 1), '-')[-1]"
SUP_IS = "({0} LIKE 'bundle\\_%\\_%' ESCAPE '\\' AND {0} LIKE '%.log' AND ({0} LIKE '%-stderr---supervisor-%' OR {0} LIKE '%-stdout---supervisor-%'))"


@query("latest_log_per_stream", oracle=with_roles(
    f"""SELECT {SUP_APP.format('filename')} AS app_id, {SUP_STREAM.format('filename')} AS stream, max(filename) AS log_id
       FROM conf_name WHERE {SUP_IS.format('filename')} GROUP BY 1, 2""", "conf_name"))
def q_latest_log_per_stream(spark, sf):
    """X-8 / W-6: newest supervisor log per (app, stream)."""
    listing = Roles(spark, sf).conf_name.select(F.col("filename").alias("name"), F.lit("any").alias("hostname"))
    return logs.latest_per_stream(listing, ()).select("app_id", "stream", "log_id")


def _listing(r):
    """Log folder listing of every host: each file lives on host slot
    ``id % n_hosts``; its size and mtime come from the event it was derived from."""
    from opsframe.driver.tables import host_slots
    ev = r.events.select(F.col("event_id").alias("id"), "ts", "value")
    slots, n = host_slots(r.host)
    hosts = slots.select("slot", F.col("name").alias("hostname"))
    return (r.conf_name.join(ev, "id")
            .withColumn("slot", F.col("id") % F.lit(n))
            .join(hosts, "slot")
            .select("hostname", F.col("filename").alias("name"),
                    F.floor(F.col("value") * 1000).cast("bigint").alias("filesize"),
                    (epoch_micros("ts") / F.lit(1e6)).alias("mod_time")))


LISTING_CTE = f"""
hs AS (SELECT *, row_number() OVER (ORDER BY instance_id) - 1 AS slot FROM host),
listing AS (SELECT h.name AS hostname, c.filename AS name, CAST(floor(e.value * 1000) AS BIGINT) AS filesize,
                   epoch_us(e.ts) / 1e6 AS mod_time
            FROM conf_name c JOIN events e ON e.event_id = c.id
            JOIN hs h ON h.slot = c.id % (SELECT count(*) FROM host)),
sup AS (SELECT *, {SUP_APP.format('name')} AS app_id, {SUP_STREAM.format('name')} AS stream
        FROM listing WHERE {SUP_IS.format('name')}),
newest AS (SELECT hostname, app_id, stream, max(name) AS log_id FROM sup GROUP BY ALL),
cat AS (SELECT n.hostname, n.app_id, n.stream, n.log_id, s.filesize, s.mod_time,
               CASE n.stream WHEN 'stderr' THEN 'Application Standard Error' WHEN 'stdout' THEN 'Application Standard Output'
                             WHEN 'access' THEN 'Web Server Access Log' END AS caption,
               make_timestamp(CAST(trunc(s.mod_time * 1000000) AS BIGINT)) AS mod_dt
        FROM newest n JOIN sup s ON s.hostname = n.hostname AND s.app_id = n.app_id AND s.stream = n.stream
                                  AND s.name = n.log_id)"""


@query("log_catalog", oracle=with_roles(
    """SELECT cat.*, p.id AS project_id FROM cat
       LEFT JOIN project p ON p.id = TRY_CAST(regexp_extract(cat.app_id, '^p([0-9]+)$', 1) AS BIGINT)""",
    "conf_name", "host", "project", extra=LISTING_CTE))
def q_log_catalog(spark, sf):
    """C-7 / S-6 / S-19 / U-2 / X-9 / J-13: every host's newest logs per app
    and stream, captioned, with the owning project (app id → project id)."""
    r = Roles(spark, sf)
    cat = logs.log_catalog(_listing(r))
    pid = F.regexp_extract("app_id", r"^p([0-9]+)$", 1).try_cast("bigint")
    proj = r.project.select(F.col("id").alias("project_id"))
    return cat.join(proj, pid == F.col("project_id"), "left")


ACCESS_SQL = """
SELECT q.hostname, q.app_id, q.log_id,
       CASE WHEN c.log_id IS NULL THEN 'unavailable' ELSE 'ok' END AS status,
       CASE WHEN c.log_id IS NULL THEN 0 ELSE coalesce(p.n_lines, 0) END AS n_lines,
       CASE WHEN c.log_id IS NULL THEN '' ELSE coalesce(p.page, '') END AS page
FROM (SELECT source AS hostname, lang AS app_id, doc_id AS log_id FROM documents) q
LEFT JOIN (SELECT source AS hostname, lang AS app_id, max(doc_id) AS log_id FROM documents GROUP BY 1, 2) c
  ON c.hostname = q.hostname AND c.app_id = q.app_id AND c.log_id = q.log_id
LEFT JOIN (SELECT hostname, log_id, count(*) AS n_lines, string_agg(line, chr(10) ORDER BY line_no) AS page
           FROM (SELECT *, row_number() OVER (PARTITION BY hostname, log_id ORDER BY line_no DESC) AS rn FROM logline)
           WHERE rn <= 100 GROUP BY 1, 2) p ON p.hostname = q.hostname AND p.log_id = q.log_id"""


@query("log_access", oracle=with_roles(ACCESS_SQL, "logline"))
def q_log_access(spark, sf):
    """F-15 / A-10 / T-1 / T-6: page requests for every log; only each
    (host, app)'s newest log is available, others are refused."""
    r = Roles(spark, sf)
    docs = r.documents.select(F.col("source").alias("hostname"), F.col("lang").alias("app_id"),
                              F.col("doc_id").alias("log_id"))
    catalog = docs.groupBy("hostname", "app_id").agg(F.max("log_id").alias("log_id"))
    lines = r.logline.select("hostname", "log_id", "line_no", "line")
    out = logs.log_page(lines, catalog, docs)
    return out.select("hostname", "app_id", "log_id", "status", "n_lines", "page")


SECTION_SPLIT = r"\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]"


def _help_text(text, lang):
    """Render a document as ``manage.py help`` output: English documents carry
    the subcommand marker followed by one word per line."""
    return F.when(lang == "en", F.concat(text, F.lit("\nAvailable subcommands:\n  "),
                                         F.regexp_replace(text, " +", "\n  "))).otherwise(text)


SECTION_SQL = f"""
SELECT doc_id, has_marker, n_section_lines, has_collectstatic, has_migrate FROM (
  SELECT doc_id, strpos(h, 'Available subcommands:') > 0 AS has_marker,
         CAST(CASE WHEN strpos(h, 'Available subcommands:') > 0 THEN len(sec) END AS INTEGER) AS n_section_lines,
         coalesce(CASE WHEN strpos(h, 'Available subcommands:') > 0 THEN list_contains(sec, 'collectstatic') END, false) AS has_collectstatic,
         coalesce(CASE WHEN strpos(h, 'Available subcommands:') > 0 THEN list_contains(sec, 'migrate') END, false) AS has_migrate
  FROM (SELECT doc_id, h, list_transform(
          CASE WHEN t = '' THEN [] WHEN regexp_matches(t, '({SECTION_SPLIT})$')
               THEN string_split_regex(t, '{SECTION_SPLIT}')[1:-2] ELSE string_split_regex(t, '{SECTION_SPLIT}') END,
          lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')) AS sec
        FROM (SELECT doc_id, h, split_part(h, 'Available subcommands:', -1) AS t
              FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN text || chr(10) || 'Available subcommands:' || chr(10) || '  '
                                        || regexp_replace(text, ' +', chr(10) || '  ', 'g') ELSE text END AS h
                    FROM documents))))"""


@query("section_membership", oracle=with_roles(SECTION_SQL))
def q_section_membership(spark, sf):
    """X-23: subcommand section after the last marker; membership of
    ``collectstatic`` / ``migrate``; marker absent → has_marker false (warning)."""
    d = Roles(spark, sf).documents
    h = _help_text(F.col("text"), F.col("lang"))
    sec = T.subcommand_section(h)
    return d.select("doc_id", (F.instr(h, T.SUBCOMMANDS_MARKER) > 0).alias("has_marker"),
                    F.size(sec).alias("n_section_lines"),
                    F.coalesce(F.array_contains(sec, "collectstatic"), F.lit(False)).alias("has_collectstatic"),
                    F.coalesce(F.array_contains(sec, "migrate"), F.lit(False)).alias("has_migrate"))


@query("command_args", oracle=with_roles(
    """SELECT log_id, CAST(line_no AS INTEGER) AS line_no, len(a) AS n_args, a[1] AS first_arg, a[-1] AS last_arg FROM (
         SELECT log_id, line_no, CASE WHEN regexp_replace(line, '^\\s+|\\s+$', '', 'g') = '' THEN []
                ELSE string_split_regex(regexp_replace(line, '^\\s+|\\s+$', '', 'g'), '\\s+') END AS a FROM logline)""",
    "logline"))
def q_command_args(spark, sf):
    """X-24: every log line as a command string split into arguments."""
    ll = Roles(spark, sf).logline
    a = T.command_args("line")
    return ll.select("log_id", "line_no", F.size(a).cast("bigint").alias("n_args"),
                     F.try_element_at(a, F.lit(1)).alias("first_arg"), F.try_element_at(a, F.lit(-1)).alias("last_arg"))


@query("command_output", oracle=with_roles(
    """SELECT conv_id, turn, text || chr(10) || role AS output,
              concat_ws(chr(10), text, nullif(CASE WHEN role = 'assistant' THEN '' ELSE role END, '')) AS shell_output
       FROM conversations""", ))
def q_command_output(spark, sf):
    """X-27: stdout + newline + stderr; the shell variant adds stderr only
    when non-empty (turn text = stdout, non-assistant role = stderr)."""
    c = Roles(spark, sf).conversations
    err = F.when(F.col("role") == "assistant", F.lit("")).otherwise(F.col("role"))
    return c.select("conv_id", "turn", T.joined_output(F.col("text"), F.col("role")).alias("output"),
                    T.joined_output(F.col("text"), err, shell=True).alias("shell_output"))


@query("kv_report", oracle=with_roles(
    f"""SELECT log_id, k AS key, arg_max(v, line_no) AS value, count(*) AS n_lines FROM (
         SELECT log_id, line_no, regexp_extract(l, '^(.*?): (.*)$', 1) AS k, regexp_extract(l, '^(.*?): (.*)$', 2) AS v
         FROM (SELECT conv_id AS log_id, turn AS line_no, role || ': ' || text AS l FROM conversations)
         WHERE line_no > 0 AND regexp_matches(l, '^(.*?): (.*)$'))
       GROUP BY log_id, k"""))
def q_kv_report(spark, sf):
    """X-28 + A-9: every conversation rendered as a ``role: text`` report
    (turn 0 is the header and skipped), parsed back into one row per
    (conversation, key) — last value wins."""
    c = Roles(spark, sf).conversations
    ll = c.select(F.col("conv_id").alias("log_id"), F.col("turn").alias("line_no"),
                  F.concat(F.col("role"), F.lit(": "), F.col("text")).alias("line")).filter(F.col("line_no") > 0)
    kv = ll.select("log_id", "line_no", T.kv_pair("line").alias("kv")).filter(F.col("kv").isNotNull())
    return kv.groupBy("log_id", F.col("kv.key").alias("key")).agg(
        F.max_by(F.col("kv.value"), "line_no").alias("value"), F.count(F.lit(1)).alias("n_lines"))


@query("truncate_revision", oracle=with_roles(
    """SELECT doc_id, CASE WHEN length(coalesce(text, '')) > 512 THEN substr(text, 1, 509) || '...'
                           ELSE coalesce(text, '') END AS revision FROM documents"""))
def q_truncate_revision(spark, sf):
    """X-5 / S-3: stored revision text (null → "", >512 → 509 + "...")."""
    d = Roles(spark, sf).documents
    return d.select("doc_id", naming.truncate_revision("text").alias("revision"))


@query("bundle_names", oracle=with_roles(
    f"""SELECT id, app_id, built_at,
               built_at IS NOT NULL AND 'bundle_' || app_id || '_' || strftime(built_at, '%Y-%m-%d-%H.%M.%S') = bundle_name AS roundtrip_ok
        FROM (SELECT id, bundle_name, CASE WHEN fits THEN substr(bundle_name, 8, length(bundle_name) - 27) ELSE '' END AS app_id,
                     CASE WHEN fits THEN try_strptime(right(bundle_name, 19), '%Y-%m-%d-%H.%M.%S') END AS built_at
              FROM (SELECT *, bundle_name SIMILAR TO 'bundle_.*_\\d{{4}}-\\d\\d-\\d\\d-\\d\\d[.]\\d\\d[.]\\d\\d' AS fits FROM bundle))""", "bundle"))
def q_bundle_names(spark, sf):
    """X-6: parse app id and build time out of bundle names and format back."""
    b = Roles(spark, sf).bundle
    app, ts = naming.bundle_name_app("bundle_name"), naming.bundle_name_time("bundle_name")
    out = b.select("id", "bundle_name", app.alias("app_id"), ts.cast("timestamp_ntz").alias("built_at"))
    return out.select("id", "app_id", "built_at", F.coalesce(
        naming.bundle_name(F.col("app_id"), F.col("built_at")) == F.col("bundle_name"), F.lit(False)).alias("roundtrip_ok"))


@query("first_reply", oracle=with_roles(
    """SELECT log_id, coalesce(arg_min(line, line_no) FILTER (WHERE line_no % 3 <> 0 AND line <> ''), '') AS result FROM turnlog GROUP BY log_id""", "turnlog"))
def q_first_reply(spark, sf):
    """T-6: per request the first non-empty reply in host order (turn n of a conversation is host n's reply;
    every third host answers nothing)."""
    t = Roles(spark, sf).turnlog.select("log_id", F.col("line_no").alias("pos"), F.when(F.col("line_no") % 3 == 0, F.lit("")).otherwise(F.col("line")).alias("reply"))
    return logs.first_nonempty_reply(t, "log_id")


@query("log_service", oracle=with_roles(
    f"""SELECT a.app_id, coalesce(p.n_logs, 0) AS n_logs, coalesce(p.n_hosts, 0) AS n_hosts,
               CASE WHEN (SELECT count(*) FROM listing) = 0 THEN 'service_not_available'
                    WHEN coalesce(p.n_logs, 0) > 0 THEN 'ok' ELSE 'no_logs' END AS status
        FROM (SELECT DISTINCT app_id FROM wconf) a
        LEFT JOIN (SELECT app_id, count(*) AS n_logs, count(DISTINCT hostname) AS n_hosts FROM sup GROUP BY app_id) p
          ON p.app_id = a.app_id""", "conf_name", "host", extra=WORKER_CONF_CTE + "," + LISTING_CTE))
def q_log_service(spark, sf):
    """S-19: log availability of every app that has a worker config: ok /
    no_logs / service_not_available (nobody answered)."""
    from opsframe.plans.inventory import active_bundles
    r = Roles(spark, sf)
    apps = active_bundles(r.conf_name, "filename").select("app_id")
    return logs.log_service_status(_listing(r), apps).select("app_id", "n_logs", "n_hosts", "status")
