"""Driver queries: host inventory parsers, health, proxy sites, free ports."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsframe.driver.routing import ROUTING_ROLES, SITE_SQL
from opsframe.operators import aggregates as A
from opsframe.operators import joins as J
from opsframe.operators.windows import keyed_index
from opsframe.plans import inventory as I
from opsframe.registry import query
from opsframe.sources.roles import Roles, with_roles

# the oracle takes worker config names apart in its own way: at dots, the last ".port." counts
WORKER_CONF_CTE = """
wsplit AS (SELECT id, filename, split_part(filename, '.', 1) AS app_id, string_split(filename, '.port.') AS s FROM conf_name WHERE ends_with(filename, '.conf')),
wconf AS (SELECT id, filename, app_id, substr(array_to_string(s[1:len(s) - 1], '.port.'), length(app_id) + 2) AS bundle_name,
                 TRY_CAST(trim(left(s[-1], length(s[-1]) - 5)) AS INTEGER) AS port
          FROM wsplit WHERE len(s) > 1 AND contains(array_to_string(s[1:len(s) - 1], '.port.'), '.')
            AND TRY_CAST(trim(left(s[-1], length(s[-1]) - 5)) AS INTEGER) IS NOT NULL)"""


@query("parse_conf_names", oracle=with_roles("SELECT id, filename, app_id, bundle_name, port FROM wconf", "conf_name", extra=WORKER_CONF_CTE))
def q_parse_conf_names(spark, sf):
    """X-7 / S-8: worker config names → (app, bundle, port); bad ports skipped."""
    c = Roles(spark, sf).conf_name
    return I.active_bundles(c, "filename").select("id", "filename", "app_id", "bundle_name", "port")


OTHER_CTES = WORKER_CONF_CTE + """,
inst AS (SELECT DISTINCT app_id, bundle_name FROM wconf),
keep AS (SELECT app_id, max(bundle_name) AS keep_bundle FROM inst GROUP BY app_id)"""


@query("other_bundles", oracle=with_roles(
    """SELECT i.app_id, i.bundle_name, k.keep_bundle FROM inst i JOIN keep k ON k.app_id = i.app_id
       WHERE starts_with(i.bundle_name, 'bundle_') AND i.bundle_name <> k.keep_bundle""", "conf_name", extra=OTHER_CTES))
def q_other_bundles(spark, sf):
    """F-14: per app, installed bundles other than the kept (newest-named) one."""
    inst = I.active_bundles(Roles(spark, sf).conf_name, "filename").select("app_id", "bundle_name").distinct()
    keep = inst.groupBy("app_id").agg(F.max("bundle_name").alias("keep_bundle"))
    return I.other_bundles(inst, keep).select("app_id", "bundle_name", "keep_bundle")


def _procs(r):
    """Process table of every host: each active deployment runs a gunicorn
    master, two workers and one unrelated process (pid = id*10 + k)."""
    d = r.deployment.filter(F.col("deactivation_date").isNull())
    k = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k")
    p = d.select("id", "server_ip", "bundle_id", "server_port", "project_id", k)
    kind = F.when(F.col("k") == 0, "master").otherwise("worker")
    cmd = F.when(F.col("k") == 3, F.lit("python manage.py runserver")).otherwise(F.concat(
        F.lit("gunicorn: "), kind, F.lit(" ['bundle_"), F.col("bundle_id").cast("string"), F.lit(" on :"),
        F.col("server_port").cast("string"), F.lit("']")))
    return p.select(F.col("server_ip").alias("host"), (F.col("id") * 10 + F.col("k")).alias("pid"),
                    (F.col("id") * 10 + F.col("k")).alias("pos"),
                    F.concat(F.lit("u"), F.col("project_id").cast("string")).alias("user"), cmd.alias("command"))


GT = r"^gunicorn: (master|worker) \['(\S+) on :(\d+)'\]\s*$".replace("'", "''")

PROCS_CTE = """
procs AS (SELECT d.server_ip AS host, d.id * 10 + t.k AS pid, d.id * 10 + t.k AS pos, 'u' || CAST(d.project_id AS VARCHAR) AS "user",
                 CASE WHEN t.k = 3 THEN 'python manage.py runserver'
                      ELSE 'gunicorn: ' || CASE WHEN t.k = 0 THEN 'master' ELSE 'worker' END || ' [''bundle_'
                           || CAST(d.bundle_id AS VARCHAR) || ' on :' || CAST(d.server_port AS VARCHAR) || ''']' END AS command
          FROM deployment d CROSS JOIN range(4) t(k) WHERE d.deactivation_date IS NULL)"""


@query("proc_groups", oracle=with_roles(
    f"""SELECT host, b AS bundle_name, arg_min(port, pos) AS port, arg_min("user", pos) AS "user",
               arg_max(pid, pos) FILTER (WHERE kind = 'master') AS master_pid,
               count(*) FILTER (WHERE kind = 'worker') AS n_workers,
               coalesce(string_agg(CAST(pid AS VARCHAR), ',' ORDER BY pid) FILTER (WHERE kind = 'worker'), '') AS worker_pids
        FROM (SELECT *, regexp_extract(command, '{GT}', 1) AS kind, regexp_extract(command, '{GT}', 2) AS b,
                     CAST(regexp_extract(command, '{GT}', 3) AS INTEGER) AS port
              FROM procs WHERE regexp_matches(command, '{GT}'))
        GROUP BY host, b""", "deployment", extra=PROCS_CTE))
def q_proc_groups(spark, sf):
    """A-2 / X-21 / S-11 / T-3: gunicorn processes grouped per (host, bundle)."""
    g = A.proc_groups(_procs(Roles(spark, sf)))
    return g.select("host", "bundle_name", "port", "user", "master_pid",
                    F.size("worker_pids").cast("bigint").alias("n_workers"),
                    F.array_join("worker_pids", ",").alias("worker_pids")).orderBy("host", "bundle_name")  # T-3


def _df_lines(r):
    """`df -h` / `df -i` output of every host (space, then inode report)."""
    h = r.host
    pct2 = (F.floor(F.abs(F.col("load_raw"))).cast("int") % 101).cast("string")
    def line(t, no, text):
        return F.struct(F.lit(t).alias("type"), F.lit(no).alias("line_no"), text.alias("line"))
    rows = F.array(
        line("space", 0, F.lit("Filesystem      Size  Used Avail Use% Mounted on")),
        line("space", 1, F.concat(F.lit("/dev/xvda1       99G   42G   57G  "), F.col("space_pct").cast("string"), F.lit("% /"))),
        line("space", 2, F.lit("tmpfs           1.9G     0  1.9G   0% /dev/shm")),
        line("inode", 0, F.lit("Filesystem      Inodes IUsed IFree IUse% Mounted on")),
        line("inode", 1, F.concat(F.lit("/dev/xvda1      6.3M  1M  5M  "), F.col("inode_pct").cast("string"), F.lit("% /"))),
        line("inode", 2, F.concat(F.lit(".host:/share    1.0M 1 1 "), pct2, F.lit("% /mnt/hgfs"))))
    return h.select(F.col("instance_id").alias("host"), F.explode(rows).alias("r")).select("host", "r.*")


DF_CTE = """
dfl AS (
  SELECT instance_id AS host, 'space' AS type, 0 AS line_no, 'Filesystem      Size  Used Avail Use% Mounted on' AS line FROM host
  UNION ALL SELECT instance_id, 'space', 1, '/dev/xvda1       99G   42G   57G  ' || CAST(space_pct AS VARCHAR) || '% /' FROM host
  UNION ALL SELECT instance_id, 'space', 2, 'tmpfs           1.9G     0  1.9G   0% /dev/shm' FROM host
  UNION ALL SELECT instance_id, 'inode', 0, 'Filesystem      Inodes IUsed IFree IUse% Mounted on' FROM host
  UNION ALL SELECT instance_id, 'inode', 1, '/dev/xvda1      6.3M  1M  5M  ' || CAST(inode_pct AS VARCHAR) || '% /' FROM host
  UNION ALL SELECT instance_id, 'inode', 2, '.host:/share    1.0M 1 1 ' || CAST(CAST(floor(abs(load_raw)) AS INTEGER) % 101 AS VARCHAR)
            || '% /mnt/hgfs' FROM host),
md AS (
  SELECT host, pct, type, detail FROM (
    SELECT c.host, c.pct, c.type, h.line || chr(10) || c.line AS detail,
           row_number() OVER (PARTITION BY c.host ORDER BY c.pct DESC, CASE c.type WHEN 'space' THEN 0 ELSE 1 END, c.line_no) AS rn
    FROM (SELECT *, CASE WHEN ends_with(string_split_regex(trim(line), '\\s+')[-2], '%')
                         THEN TRY_CAST(rtrim(string_split_regex(trim(line), '\\s+')[-2], '%') AS INTEGER) END AS pct
          FROM dfl WHERE starts_with(line, '/dev') OR starts_with(line, '.host')) c
    JOIN dfl h ON h.host = c.host AND h.type = c.type AND h.line_no = 0
    WHERE c.pct > 0) WHERE rn = 1),
mdall AS (SELECT h.instance_id AS host, coalesce(md.pct, 0) AS pct, md.type, md.detail
          FROM host h LEFT JOIN md ON md.host = h.instance_id)"""


@query("df_report", oracle=with_roles(
    """SELECT host, type, 0 AS part, line_no, line FROM dfl WHERE line_no = 0 OR starts_with(line, '/dev')
       UNION ALL SELECT DISTINCT host, type, 1, NULL, '' FROM dfl""", "host", extra=DF_CTE))
def q_df_report(spark, sf):
    """S-12 / U-4: the kept lines of both disk reports of every host."""
    return I.df_report(_df_lines(Roles(spark, sf)))


@query("max_disk", oracle=with_roles("SELECT * FROM mdall", "host", extra=DF_CTE))
def q_max_disk(spark, sf):
    """A-3 / X-20: highest disk use per host (first maximum wins)."""
    r = Roles(spark, sf)
    return I.max_disk(r.host.select(F.col("instance_id").alias("host")), _df_lines(r))


@query("fleet_health", oracle=with_roles(
    """SELECT m.host, m.pct, m.type, m.detail, h.load_raw AS loadavg_curr, h.load_raw * 3600 AS uptime, coalesce(t.n, 0) AS num_active_items,
              coalesce(w.n, 0) AS num_workers
       FROM mdall m JOIN host h ON h.instance_id = m.host
       LEFT JOIN (SELECT substr(queue, 11) AS host, count(*) AS n FROM job GROUP BY 1) t ON t.host = m.host
       LEFT JOIN (SELECT server_instance_id AS host, count(*) AS n FROM deployment WHERE deactivation_date IS NULL
                  GROUP BY 1) w ON w.host = m.host""", "host", "job", "deployment", extra=DF_CTE))
def q_fleet_health(spark, sf):
    """C-9 / A-11: one health row per host (max disk and its detail, load, uptime, work items, workers)."""
    r = Roles(spark, sf)
    hosts = r.host.select(F.col("instance_id").alias("host"), F.col("load_raw").alias("loadavg_curr"),
                          (F.col("load_raw") * 3600).alias("uptime"))
    work_items = r.job.select(F.expr("substring(queue, 11)").alias("host"))
    workers = r.deployment.filter(F.col("deactivation_date").isNull()).select(F.col("server_instance_id").alias("host"))
    h = I.fleet_health(hosts, _df_lines(r), work_items, workers)
    return h.select("host", "pct", "type", "detail", "loadavg_curr", "uptime", "num_active_items", "num_workers")


SITE_PARSE = """
ln AS (SELECT site, section, ord, sub, line FROM (
         SELECT app_id AS site, section, ord, generate_subscripts(a, 1) AS sub, unnest(a) AS line
         FROM (SELECT app_id, section, ord, string_split(line, chr(10)) AS a FROM lines))),
tk AS (SELECT site, section, ord, sub,
              string_split_regex(regexp_replace(regexp_replace(regexp_replace(line, '^\\s+|\\s+$', '', 'g'), ';+$', ''),
                                                '^\\s+|\\s+$', '', 'g'), '\\s+') AS t FROM ln),
parsed AS (
  SELECT site,
         arg_max(t[2], (section, ord, sub)) FILTER (WHERE t[1] = 'server' AND t[2] <> '{') AS server,
         array_to_string(arg_max(t[2:], (section, ord, sub)) FILTER (WHERE t[1] = 'server_name'), ' ') AS server_names,
         arg_max(string_split(t[2], '/')[4], (section, ord, sub)) FILTER (WHERE t[1] = 'alias') AS bundle_name,
         count(*) FILTER (WHERE t[1] = 'alias' AND len(string_split(t[2], '/')) < 4) AS n_bad_alias
  FROM tk WHERE len(t) >= 2 GROUP BY site)"""


@query("site_files", oracle=with_roles("SELECT * FROM parsed", *ROUTING_ROLES, extra=SITE_SQL + "," + SITE_PARSE))
def q_site_files(spark, sf):
    """S-10 / X-22: the rendered proxy site files (C-4) parsed back."""
    from opsframe.driver.routing import q_site_config_text
    lines = q_site_config_text(spark, sf)
    s = lines.select(F.col("app_id").alias("site"), F.struct("section", "ord").alias("ord"), F.col("line").alias("text"))
    return (I.site_files(s).withColumn("server_names", F.array_join("server_name", " ")).drop("server_name"))


@query("node_meta", oracle=with_roles(
    """SELECT instance_id AS host, instance_id, name, CASE WHEN role <> 'build' THEN role ELSE 'localhost' END AS role
       FROM host""", "host"))
def q_node_meta(spark, sf):
    """S-17: every host's metadata files (one per field; build hosts have no
    role file) read back, stripped, with the off-cloud fallback."""
    h = Roles(spark, sf).host
    def file(field, text):
        return F.struct(F.lit(field).alias("field"), text.alias("text"))
    files = F.array(
        file("instance_id", F.concat(F.col("instance_id"), F.lit("\n"))),
        file("name", F.concat(F.lit("  "), F.col("name"), F.lit("\n"))),
        F.when(F.col("role") != "build", file("role", F.concat(F.col("role"), F.lit("\n")))))
    meta = (h.select(F.col("instance_id").alias("host"), F.explode(F.array_compact(files)).alias("f"))
            .select("host", "f.field", "f.text"))
    return I.node_meta(meta, h.select(F.col("instance_id").alias("host")))


@query("installed_bundles", oracle=with_roles(
    """SELECT DISTINCT 'p' || CAST(repo_id AS VARCHAR) AS app_id, string_split(path, '/')[1] AS bundle_name
       FROM repofile WHERE contains(path, '/') AND NOT starts_with(string_split(path, '/')[1], '.')
         AND string_split(path, '/')[1] <> 'src'""", "repofile"))
def q_installed_bundles(spark, sf):
    """S-9 / F-10: (app, bundle) directories of every repository tree."""
    rf = Roles(spark, sf).repofile
    return I.installed_bundles(rf, F.concat(F.lit("p"), F.col("repo_id").cast("string")))


def _port_inputs(r):
    d = r.deployment
    used = d.filter(F.col("deactivation_date").isNull()).select(F.col("server_instance_id").alias("host"),
                                                                F.col("server_port").alias("port"))
    blocked = d.filter(F.col("deactivation_date").isNotNull()).select(F.col("server_instance_id").alias("host"),
                                                                      F.col("server_port").alias("port"))
    placed, _ = J.placement(r.project, r.host)
    return used, blocked, placed


FREE_CTES = """
pl AS (SELECT p.id AS project_id, CAST(k.k AS INTEGER) AS k, a.instance_id, a.ip
       FROM project p CROSS JOIN (SELECT count(*) AS n FROM host WHERE role = 'appserver') n
       CROSS JOIN LATERAL (SELECT unnest(range(0, least(p.num_workers, n.n))) AS k) k
       JOIN (SELECT *, row_number() OVER (ORDER BY instance_id) - 1 AS slot FROM host WHERE role = 'appserver') a
         ON a.slot = (p.id + k.k) % n.n),
used AS (SELECT server_instance_id AS host, server_port AS port FROM deployment WHERE deactivation_date IS NULL),
blocked0 AS (SELECT server_instance_id AS host, server_port AS port FROM deployment WHERE deactivation_date IS NOT NULL),
req AS (SELECT instance_id AS host, count(*) AS n_req FROM pl GROUP BY 1),
maxu AS (SELECT host, greatest(10000, max(port)) AS m FROM used GROUP BY host),
r AS (SELECT req.host, req.n_req, coalesce(maxu.m, 10000) AS m FROM req LEFT JOIN maxu ON maxu.host = req.host),
blk AS (SELECT DISTINCT b.host, b.port FROM blocked0 b JOIN r ON r.host = b.host WHERE b.port > r.m),
nb AS (SELECT host, count(*) AS n_blk FROM blk GROUP BY host),
cand AS (SELECT r.host, unnest(range(r.m + 1, least(r.m + r.n_req + coalesce(nb.n_blk, 0), 25000) + 1)) AS port
         FROM r LEFT JOIN nb ON nb.host = r.host),
free AS (SELECT host, port, row_number() OVER (PARTITION BY host ORDER BY port) - 1 AS request_no FROM cand c
         WHERE NOT EXISTS (SELECT 1 FROM blk b WHERE b.host = c.host AND b.port = c.port)),
asks AS (SELECT host, unnest(range(0, n_req)) AS request_no FROM r),
alloc AS (SELECT a.host, CAST(a.request_no AS INTEGER) AS request_no, CAST(f.port AS INTEGER) AS port,
                 CASE WHEN f.port IS NULL THEN 'out_of_ports' ELSE 'ok' END AS status
          FROM asks a LEFT JOIN free f ON f.host = a.host AND f.request_no = a.request_no)"""


@query("free_ports", oracle=with_roles("SELECT * FROM alloc", "deployment", "project", "host", extra=FREE_CTES))
def q_free_ports(spark, sf):
    """W-7 / A-4 / F-12: ports for every placement request on every appserver
    (stale ports of inactive deployments are blocked)."""
    r = Roles(spark, sf)
    used, blocked, placed = _port_inputs(r)
    req = placed.groupBy(F.col("instance_id").alias("host")).agg(F.count(F.lit(1)).alias("n_req"))
    return I.free_ports(used, blocked, req).select("host", "request_no", "port", "status")


@query("zip_replies", oracle=with_roles(
    """SELECT q.project_id, q.k, q.instance_id AS host, q.ip, a.port, a.status FROM
         (SELECT *, row_number() OVER (PARTITION BY instance_id ORDER BY project_id, k) - 1 AS request_no FROM pl) q
       JOIN alloc a ON a.host = q.instance_id AND a.request_no = q.request_no""",
    "deployment", "project", "host", extra=FREE_CTES))
def q_zip_replies(spark, sf):
    """J-7: deploy requests zipped with the appservers' replies (allocated
    ports) on an explicit request number per host (a keyed dense index)."""
    r = Roles(spark, sf)
    used, blocked, placed = _port_inputs(r)
    req = placed.groupBy(F.col("instance_id").alias("host")).agg(F.count(F.lit(1)).alias("n_req"))
    replies = I.free_ports(used, blocked, req)
    asks = keyed_index(placed.drop("status").withColumnRenamed("instance_id", "host"), ["host"], ["project_id", "k"], "request_no")
    z = J.zip_by_position(asks, replies, ["host"], "request_no")
    return z.select("project_id", "k", "host", "ip", "port", "status")
