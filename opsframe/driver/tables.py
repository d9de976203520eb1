"""Driver queries: control-table filters, lookups, joins and appends."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsframe.functions import naming
from opsframe.operators import filters as Fl
from opsframe.operators import joins as J
from opsframe.operators.windows import dense_index
from opsframe.registry import query
from opsframe.session import cut_lineage, new_folder, spread
from opsframe.sources import append as A
from opsframe.sources.roles import Roles, with_roles

DEP_COLS = ("id", "project_id", "bundle_id")


def host_slots(host):
    """(hosts with a dense ``slot`` 0..n-1 in instance-id order, n). Rows that
    are spread over hosts use ``slot = id % n``, so every row lands on a host
    whatever the fleet size."""
    n = J.scalar(host.agg(F.count(F.lit(1))))
    return dense_index(host, ["instance_id"], "slot"), n


HOST_SLOTS_SQL = """
hs AS (SELECT *, row_number() OVER (ORDER BY instance_id) - 1 AS slot FROM host),
hn AS (SELECT count(*) AS n FROM host)"""


def _dep(df):
    return df.select(*DEP_COLS)


@query("workers_active", oracle=with_roles(
    "SELECT id, project_id, bundle_id FROM deployment WHERE deactivation_date IS NULL", "deployment"))
def q_workers_active(spark, sf):
    """F-2/F-3/F-4: active workers of every project; empty bundle list = no filter."""
    return _dep(Fl.search_workers(Roles(spark, sf).deployment, None, [], True))


@query("workers_inactive", oracle=with_roles(
    """SELECT id, project_id, bundle_id FROM deployment
       WHERE deactivation_date IS NOT NULL AND bundle_id IN (SELECT id FROM bundle WHERE deletion_date IS NOT NULL)""",
    "deployment", "bundle"))
def q_workers_inactive(spark, sf):
    """F-3 False + F-4 with a DataFrame of ids (deleted bundles) → left-semi."""
    r = Roles(spark, sf)
    deleted = r.bundle.filter(F.col("deletion_date").isNotNull()).select("id")
    return _dep(Fl.search_workers(r.deployment, None, deleted, False))


@query("workers_any", oracle=with_roles(
    """SELECT project_id, count(*) AS n_all, count(*) FILTER (WHERE deactivation_date IS NULL) AS n_active,
              count(*) FILTER (WHERE deactivation_date IS NOT NULL) AS n_inactive
       FROM deployment GROUP BY project_id""", "deployment"))
def q_workers_any(spark, sf):
    """F-3 None: all workers incl. inactive, counted per project (F-2 set form)."""
    d = Fl.search_workers(Roles(spark, sf).deployment, None, None, None)
    return d.groupBy("project_id").agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count(F.when(F.col("deactivation_date").isNull(), 1)).alias("n_active"),
        F.count(F.when(F.col("deactivation_date").isNotNull(), 1)).alias("n_inactive"))


@query("workers_by_ip", oracle=with_roles(
    """SELECT h.instance_id, h.ip, coalesce(c.n, 0) AS n_active FROM host h
       LEFT JOIN (SELECT server_ip, count(*) AS n FROM deployment WHERE deactivation_date IS NULL GROUP BY server_ip) c
       ON c.server_ip = h.ip""", "deployment", "host"))
def q_workers_by_ip(spark, sf):
    """F-7 set-wide: active workers on every host's ip (the ip predicate of
    one search becomes an equi-join key; counts pre-aggregated per ip)."""
    r = Roles(spark, sf)
    c = (Fl.search_allproject_workers(r.deployment, True).groupBy(F.col("server_ip").alias("ip"))
         .agg(F.count(F.lit(1)).alias("n_active")))
    return (r.host.select("instance_id", "ip").join(c, "ip", "left")
            .withColumn("n_active", F.coalesce("n_active", F.lit(0))))


BUNDLE_MONTH = "03"  # the queried release month (parameter of the search)


@query("workers_by_bundle_name", oracle=with_roles(
    f"""SELECT id, project_id, bundle_id FROM deployment WHERE deactivation_date IS NULL AND bundle_id IN
        (SELECT id FROM bundle WHERE bundle_name LIKE '%\\_2011-{BUNDLE_MONTH}-01-00.00.00' ESCAPE '\\')""",
    "deployment", "bundle"))
def q_workers_by_bundle_name(spark, sf):
    """J-14: active workers whose bundle *name* matches (left-semi on bundle)."""
    r = Roles(spark, sf)
    names = r.bundle.filter(F.col("bundle_name").endswith(f"_2011-{BUNDLE_MONTH}-01-00.00.00")).select("id")
    return _dep(Fl.search_workers(r.deployment, None, names, True))


@query("worker_bundle", oracle=with_roles(
    """SELECT d.id, d.bundle_id, b.bundle_name, d.project_id = b.project_id AS same_project
       FROM deployment d JOIN bundle b ON b.id = d.bundle_id""", "deployment", "bundle"))
def q_worker_bundle(spark, sf):
    """J-2: deployment → bundle."""
    r = Roles(spark, sf)
    j = J.worker_bundle(r.deployment, r.bundle)
    return j.select("id", "bundle_id", "bundle_name", (F.col("project_id") == F.col("bundle_project_id")).alias("same_project"))


@query("worker_addresses", oracle=with_roles(
    """SELECT id, server_instance_id AS instance_id, 'NODE_NAME_IGNORED' AS node_name, server_ip AS host_ip,
              server_port AS host_port FROM deployment WHERE deactivation_date IS NULL""", "deployment"))
def q_worker_addresses(spark, sf):
    """F-18: active deployments as (instance_id, node_name, host_ip, host_port)."""
    d = Fl.active_filter(Roles(spark, sf).deployment, True)
    return d.select("id", Fl.address().alias("a")).select("id", "a.*")


LOOKUP_SQL = """
SELECT q.request_name, coalesce(c.n, 0) AS n_found,
       CASE WHEN coalesce(c.n, 0) = 1 THEN 'ok' WHEN coalesce(c.n, 0) = 0 THEN 'missing' ELSE 'duplicate' END AS status
FROM (SELECT DISTINCT 'bundle_p' || lpad(CAST(project_id % 150 AS VARCHAR), 8, '0') || '_2011-'
                      || lpad(CAST(1 + bundle_id % 12 AS VARCHAR), 2, '0') || '-01-00.00.00' AS request_name
      FROM deployment) q
LEFT JOIN (SELECT bundle_name, count(*) AS n FROM bundle GROUP BY bundle_name) c ON c.bundle_name = q.request_name"""


@query("lookup_one_status", oracle=with_roles(LOOKUP_SQL, "deployment", "bundle"))
def q_lookup_one_status(spark, sf):
    """F-1: exactly-one lookup by bundle name for every requested name
    (names requested by deployments); ok / missing / duplicate."""
    r = Roles(spark, sf)
    req = r.deployment.select(F.concat(
        F.lit("bundle_p"), F.lpad((F.col("project_id") % 150).cast("string"), 8, "0"), F.lit("_2011-"),
        F.lpad((1 + F.col("bundle_id") % 12).cast("string"), 2, "0"), F.lit("-01-00.00.00")).alias("bundle_name")).distinct()
    out = Fl.lookup_status(r.bundle, req, ["bundle_name"])
    return out.select(F.col("bundle_name").alias("request_name"), "n_found", "status")


LOOKUP2_SQL = """
SELECT q.project_id, q.bundle_id, coalesce(c.n, 0) AS n_found,
       CASE WHEN coalesce(c.n, 0) = 1 THEN 'ok' WHEN coalesce(c.n, 0) = 0 THEN 'missing' ELSE 'duplicate' END AS status
FROM (SELECT DISTINCT project_id, bundle_id FROM deployment) q
LEFT JOIN (SELECT project_id, id, count(*) AS n FROM bundle GROUP BY project_id, id) c
  ON c.project_id = q.project_id AND c.id = q.bundle_id"""


@query("lookup_two_key", oracle=with_roles(LOOKUP2_SQL, "deployment", "bundle"))
def q_lookup_two_key(spark, sf):
    """F-5: the bundle must exist *and* belong to the deployment's project."""
    r = Roles(spark, sf)
    pair = ["project_id", "bundle_id"]
    req = spread(r.deployment.select(*pair), r.lineitem.count(), *pair).distinct()  # a deployment is a line or several
    out = Fl.lookup_status(r.bundle.select("project_id", F.col("id").alias("bundle_id")), req, ["project_id", "bundle_id"])
    return out.select("project_id", "bundle_id", "n_found", "status")


@query("safe_ids", oracle=with_roles(
    """SELECT id, filename, coalesce(regexp_full_match(filename, '[0-9A-Za-z_-]+'), false) AS safe FROM conf_name""",
    "conf_name"))
def q_safe_ids(spark, sf):
    """F-8: safe identifier check on every file name."""
    return Roles(spark, sf).conf_name.select("id", "filename", Fl.safe_identifier("filename").alias("safe"))


@query("misrouted", oracle=with_roles(
    """SELECT j.id, j.queue, h.instance_id AS delivered_to,
              coalesce(substr(j.queue, 11) = h.instance_id OR substr(j.queue, 11) = h.name
                       OR substr(j.queue, 11) = 'localhost', false) AS accepted,
              CASE j.jobcode WHEN '1-urgent' THEN 'TTIN' WHEN '2-high' THEN 'TTOU' WHEN '5-low' THEN 'KILL' END AS signal,
              coalesce(CASE j.jobcode WHEN '1-urgent' THEN 'TTIN' WHEN '2-high' THEN 'TTOU' WHEN '5-low' THEN 'KILL' END
                       IN ('TTIN', 'TTOU'), false) AS signal_ok
       FROM job j CROSS JOIN hn JOIN hs h ON h.slot = j.id % hn.n""", "job", "host", extra=HOST_SLOTS_SQL))
def q_misrouted(spark, sf):
    """F-13: a host accepts work only when the target named in the queue is
    itself (name or instance id) or ``localhost``. Every job is delivered to
    host slot ``id % n_hosts``, so some land on the wrong host. Jobs of
    priority urgent / high / low also ask for a worker signal (TTIN / TTOU /
    KILL); only TTIN and TTOU are allowed."""
    r = Roles(spark, sf)
    hosts, n = host_slots(r.host)
    signal = (F.when(F.col("jobcode") == "1-urgent", "TTIN").when(F.col("jobcode") == "2-high", "TTOU")
              .when(F.col("jobcode") == "5-low", "KILL"))
    jobs = r.job.select("id", "queue", (F.col("id") % F.lit(n)).alias("slot"), signal.alias("signal"))
    j = jobs.join(hosts.select("slot", "instance_id", "name"), "slot")
    target = F.expr("substring(queue, 11)")
    return j.select("id", "queue", F.col("instance_id").alias("delivered_to"),
                    Fl.target_accepted(target, F.col("name"), F.col("instance_id")).alias("accepted"),
                    "signal", Fl.signal_allowed("signal").alias("signal_ok"))


PLACEMENT_SQL = """
SELECT p.id AS project_id, CAST(k.k AS INTEGER) AS k, CAST((p.id + k.k) % n.n AS BIGINT) AS slot, a.instance_id, a.name, a.ip,
       'ok' AS status
FROM project p
CROSS JOIN (SELECT count(*) AS n FROM host WHERE role = 'appserver') n
CROSS JOIN LATERAL (SELECT unnest(range(0, least(p.num_workers, n.n))) AS k) k
JOIN (SELECT *, row_number() OVER (ORDER BY instance_id) - 1 AS slot FROM host WHERE role = 'appserver') a
  ON a.slot = (p.id + k.k) % n.n"""


@query("placement_errors", oracle=with_roles("SELECT id AS project_id, 'no_appservers' AS status FROM project", "project"))
def q_placement_errors(spark, sf):
    """J-8: without any appserver (here: only the other hosts are offered) every app is an error row."""
    r = Roles(spark, sf)
    _, errors = J.placement(r.project, r.host.filter(F.col("role") != "appserver"))
    return errors


@query("placement", oracle=with_roles(PLACEMENT_SQL, "project", "host"))
def q_placement(spark, sf):
    """J-8 (re-aimed): bounded placement of every app on appservers."""
    r = Roles(spark, sf)
    placed, errors = J.placement(r.project, r.host)
    return placed


OLD_SQL = """
SELECT a.id, a.project_id, a.bundle_id FROM deployment a
WHERE a.deactivation_date IS NULL AND a.id NOT IN (
  SELECT d.id FROM deployment d JOIN (SELECT project_id, max(bundle_id) AS b FROM deployment
                                      WHERE deactivation_date IS NULL GROUP BY project_id) s
  ON d.project_id = s.project_id AND d.bundle_id = s.b WHERE d.deactivation_date IS NULL)"""


@query("old_instances", oracle=with_roles(OLD_SQL, "deployment"))
def q_old_instances(spark, sf):
    """J-5 / U-5: active instances not among the new (served-bundle) ones."""
    from opsframe.plans.routing import routing_upstreams
    d = Roles(spark, sf).deployment
    new = routing_upstreams(d).select(F.col("deployment_id").alias("id"))
    return _dep(J.old_instances(Fl.active_filter(d, True), new))


APPEND_SQL = """
SELECT CAST((SELECT max(id) FROM bundle) + row_number() OVER (ORDER BY j.issued_at, j.id) AS BIGINT) AS id,
       j.project_id, 'bundle_' || printf('p%08d', j.project_id) || '_' || strftime(j.issued_at, '%Y-%m-%d-%H.%M.%S') AS bundle_name,
       j.task_id AS code_revision
FROM job j"""


@query("append_ids", oracle=with_roles(APPEND_SQL, "job", "bundle"))
def q_append_ids(spark, sf):
    """W-8 + S-3 + X-6: new bundle rows (one per job) get dense ids
    after the table's max id, in (issued_at, job id) order — no global window."""
    r = Roles(spark, sf)
    new = r.job.select(
        F.col("id").alias("job_id"), "issued_at", "project_id",
        naming.bundle_name(naming.sysid("project_id"), F.col("issued_at")).alias("bundle_name"),
        naming.truncate_revision(F.col("task_id")).alias("code_revision"))
    start = J.scalar(r.bundle.agg(F.max("id")))
    numbered = dense_index(new, ["issued_at", "job_id"], "__i").withColumn("__max", F.lit(start).cast("bigint"))
    out = numbered.select((F.col("__max") + F.col("__i") + 1).cast("bigint").alias("id"), "project_id", "bundle_name", "code_revision")
    return cut_lineage(out)


# ---- exactly-once appends: every run is executed twice, after an attempt that failed before its commit ----

def _appended_twice(spark, name, first, new, run_again, schema):
    """The table's rows after: created with ``first``; an attempt at ``new`` that is staged and never committed; the run, twice."""
    table = new_folder(spark, name)
    columns = [c.split()[0] for c in schema.split(", ")]
    A.create_table(first.select(*columns), table)
    A.stage(new.select(*[c for c in columns if c in new.columns]), table, "run-1")
    for _ in range(2):
        run_again(new, table)
    return A.read_table(spark, table, schema)


LOG_SCHEMA = "id bigint, job_id bigint, ts timestamp_ntz, message string, logtype string"
LOG_TYPES_SQL = ", ".join(f"'{t}'" for t in Fl.VALID_LOG_TYPES)


@query("append_log", oracle=with_roles(f"SELECT id, job_id, ts, message, logtype FROM joblog WHERE logtype IN ({LOG_TYPES_SQL})", "joblog"))
def q_append_log(spark, sf):
    """S-2 / F-6: job-log rows appended exactly once (the rows of even jobs are there, those of odd jobs come); unknown types are refused."""
    valid, _ = Fl.split_valid_log(Roles(spark, sf).joblog.withColumn("ts", F.col("ts").cast("timestamp_ntz")))
    return _appended_twice(spark, "joblog", valid.filter("job_id % 2 = 0"), valid.filter("job_id % 2 <> 0"),
                           lambda new, t: A.append_once(new.select(*[c.split()[0] for c in LOG_SCHEMA.split(", ")]), t, "run-1"), LOG_SCHEMA)


BUNDLE_SCHEMA = "id bigint, project_id bigint, bundle_name string, code_revision string"


@query("append_bundles", oracle=with_roles(f"SELECT id, project_id, bundle_name, code_revision FROM bundle UNION ALL ({APPEND_SQL})", "job", "bundle"))
def q_append_bundles(spark, sf):
    """S-3 / X-5 / X-6 / W-8: one new bundle per job appended exactly once, with dense ids after the table's greatest."""
    r = Roles(spark, sf)
    new = r.job.select("issued_at", F.col("id").alias("job_id"), "project_id",
                       naming.bundle_name(naming.sysid("project_id"), F.col("issued_at")).alias("bundle_name"),
                       naming.truncate_revision(F.col("task_id")).alias("code_revision"))
    return _appended_twice(spark, "bundle", r.bundle, new,
                           lambda rows, t: A.append_numbered(rows, t, "run-1", BUNDLE_SCHEMA, ["issued_at", "job_id"]), BUNDLE_SCHEMA)


WORKER_SCHEMA = ("id bigint, project_id bigint, bundle_id bigint, server_instance_id string, server_ip string, server_port int, "
                 "creation_date timestamp_ntz, deactivation_date timestamp_ntz")


@query("append_workers", oracle=with_roles(
    """SELECT id, project_id, bundle_id, server_instance_id, server_ip, server_port, CAST(creation_date AS TIMESTAMP) AS creation_date,
              CAST(deactivation_date AS TIMESTAMP) AS deactivation_date FROM deployment
       UNION ALL SELECT (SELECT max(id) FROM deployment) + row_number() OVER (ORDER BY project_id, id), project_id, id, 'i-' || CAST(project_id % 10 AS VARCHAR),
              '10.1.0.' || CAST(project_id % 10 AS VARCHAR), CAST(10001 + id % 200 AS INTEGER), CAST(creation_date AS TIMESTAMP), NULL
       FROM bundle WHERE deletion_date IS NULL""", "deployment", "bundle"))
def q_append_workers(spark, sf):
    """S-4: a new active deployment of every bundle that isn't deleted, appended exactly once with dense ids."""
    r = Roles(spark, sf)
    at = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    host = (F.col("project_id") % 10).cast("string")
    new = r.bundle.filter("deletion_date is null").select(
        "project_id", F.col("id").alias("bundle_id"), F.concat(F.lit("i-"), host).alias("server_instance_id"), F.concat(F.lit("10.1.0."), host).alias("server_ip"),
        (F.col("id") % 200 + 10001).cast("int").alias("server_port"), at("creation_date"), F.lit(None).cast("timestamp_ntz").alias("deactivation_date"))
    old = r.deployment.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("creation_date", "deactivation_date")})
    return _appended_twice(spark, "deployment", old, new,
                           lambda rows, t: A.append_numbered(rows, t, "run-1", WORKER_SCHEMA, ["project_id", "bundle_id"]), WORKER_SCHEMA)


@query("store_catalog", oracle=with_roles(
    """SELECT coalesce(b.key, s.key) AS key, b.id,
              CASE WHEN b.id IS NULL THEN 'orphan' WHEN s.key IS NOT NULL THEN 'present'
                   WHEN b.deletion_date IS NOT NULL THEN 'deleted' ELSE 'missing' END AS status
       FROM (SELECT id, deletion_date, bundle_name || '.tgz' AS key FROM bundle) b
       FULL OUTER JOIN (SELECT DISTINCT b.bundle_name || '.tgz' AS key FROM deployment d JOIN bundle b ON b.id = d.bundle_id
                        WHERE d.deactivation_date IS NULL) s ON s.key = b.key""", "deployment", "bundle"))
def q_store_catalog(spark, sf):
    """S-16: bundle store catalog; the store holds the archives of bundles
    with an active deployment (uploaded when deployed)."""
    from opsframe.operators.mutations import store_catalog
    r = Roles(spark, sf)
    stored = (Fl.active_filter(r.deployment, True).join(r.bundle.select(F.col("id").alias("bundle_id"), "bundle_name"), "bundle_id")
              .select(F.concat(F.col("bundle_name"), F.lit(".tgz")).alias("key")))
    return store_catalog(r.bundle, stored)


CHECKS_SQL = """
SELECT 'deployment' AS "table", 'not_null(project_id)' AS "constraint", count(*) FILTER (WHERE project_id IS NULL) AS n_violations FROM deployment
UNION ALL SELECT 'deployment', 'not_null(server_ip)', count(*) FILTER (WHERE server_ip IS NULL) FROM deployment
UNION ALL SELECT 'deployment', 'check(server_port >= 0)', count(*) FILTER (WHERE NOT coalesce(server_port >= 0, true)) FROM deployment
UNION ALL SELECT 'deployment', 'unique(id)', count(*) FILTER (WHERE n > 1) FROM (SELECT id, count(*) AS n FROM deployment WHERE id IS NOT NULL GROUP BY id)
UNION ALL SELECT 'vhost', 'not_null(project_id)', count(*) FILTER (WHERE project_id IS NULL) FROM vhost
UNION ALL SELECT 'vhost', 'unique(hostname)', count(*) FILTER (WHERE n > 1) FROM (SELECT hostname, count(*) AS n FROM vhost WHERE hostname IS NOT NULL GROUP BY hostname)
UNION ALL SELECT 'project', 'not_null(title)', count(*) FILTER (WHERE title IS NULL) FROM project
UNION ALL SELECT 'project', 'unique(hostname_slug)', count(*) FILTER (WHERE n > 1) FROM (SELECT hostname_slug, count(*) AS n FROM project WHERE hostname_slug IS NOT NULL GROUP BY hostname_slug)
UNION ALL SELECT 'bundle', 'not_null(bundle_name)', count(*) FILTER (WHERE bundle_name IS NULL) FROM bundle
UNION ALL SELECT 'bundle', 'check(length(code_revision) <= 512)', count(*) FILTER (WHERE NOT coalesce(length(code_revision) <= 512, true)) FROM bundle"""


@query("table_checks", oracle=with_roles(CHECKS_SQL, "deployment", "vhost", "project", "bundle"))
def q_table_checks(spark, sf):
    """F-9 / §1.2: NOT NULL, UNIQUE and CHECK constraints of the control
    tables, evaluated as data (an empty slug repeats, so it shows up)."""
    r = Roles(spark, sf)
    parts = [
        Fl.constraint_violations(r.deployment, "deployment", ("project_id", "server_ip"), ("id",),
                                 {"server_port >= 0": F.col("server_port") >= 0}),
        Fl.constraint_violations(r.vhost, "vhost", ("project_id",), ("hostname",)),
        Fl.constraint_violations(r.project, "project", ("title",), ("hostname_slug",)),
        Fl.constraint_violations(r.bundle, "bundle", ("bundle_name",), (),
                                 {"length(code_revision) <= 512": F.length("code_revision") <= 512}),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
