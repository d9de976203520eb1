"""Driver queries: undeploy and recovery plans, row changes, newest/served bundles."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsframe.operators import aggregates as A
from opsframe.operators import mutations as M
from opsframe.operators.filters import active_filter
from opsframe.plans import deploys
from opsframe.plans.routing import served_bundles
from opsframe.registry import query
from opsframe.session import cut_lineage
from opsframe.sources.roles import Roles, with_roles

# The run time stamped by row changes (a job parameter, fixed so reruns agree).
NOW = "2030-01-01 00:00:00"
NOW_SQL = f"TIMESTAMP '{NOW}'"


def _deleted_bundle_requests(r):
    """Undeploy requests: every deployment of a deleted bundle, by dep id
    (inactive ones included → warnings)."""
    deleted = r.bundle.filter(F.col("deletion_date").isNotNull()).select(F.col("id").alias("bundle_id"))
    return r.deployment.join(deleted, "bundle_id", "left_semi").select("project_id", F.col("id").alias("dep_id"))


def _with_deployments(r):
    """The deployment view written once: the plan reads it several times."""
    r.deployment = cut_lineage(r.deployment)
    return r


PLAN_COLUMNS = ["project_id", "n_matched", "n_warnings", "n_remaining", "action", "static_bundle_id"]

REQ_CTE = """
req AS (SELECT d.project_id, d.id AS dep_id FROM deployment d
        WHERE d.bundle_id IN (SELECT id FROM bundle WHERE deletion_date IS NOT NULL)),
snap AS (SELECT d.id, d.project_id, d.bundle_id, d.creation_date,
                CASE WHEN r.dep_id IS NOT NULL THEN """ + NOW_SQL + """ ELSE d.deactivation_date END AS deactivation_date,
                r.dep_id IS NOT NULL AND d.deactivation_date IS NOT NULL AS was_deactivated,
                r.dep_id IS NOT NULL AS changed
         FROM deployment d LEFT JOIN (SELECT DISTINCT project_id, dep_id FROM req) r
           ON r.project_id = d.project_id AND r.dep_id = d.id)"""

UNDEPLOY_SQL = """
SELECT p.project_id, coalesce(m.n_matched, 0) AS n_matched, coalesce(m.n_warnings, 0) AS n_warnings,
       coalesce(k.n_remaining, 0) AS n_remaining,
       CASE WHEN coalesce(m.n_matched, 0) = 0 THEN 'error' WHEN coalesce(k.n_remaining, 0) > 0 THEN 'update' ELSE 'remove' END AS action,
       CASE WHEN coalesce(m.n_matched, 0) > 0 AND coalesce(k.n_remaining, 0) > 0 THEN k.static_bundle_id END AS static_bundle_id
FROM (SELECT DISTINCT project_id FROM req) p
LEFT JOIN (SELECT project_id, count(*) AS n_matched, count(*) FILTER (WHERE was_deactivated) AS n_warnings
           FROM snap WHERE changed GROUP BY project_id) m ON m.project_id = p.project_id
LEFT JOIN (SELECT project_id, count(*) AS n_remaining, arg_max(bundle_id, (creation_date, -id)) AS static_bundle_id
           FROM snap WHERE deactivation_date IS NULL GROUP BY project_id) k ON k.project_id = p.project_id"""


@query("undeploy_plan", oracle=with_roles(UNDEPLOY_SQL, "deployment", "bundle", extra=REQ_CTE))
def q_undeploy_plan(spark, sf):
    """C-1 / J-4 / F-16 / A-5: undeploy every deployment of a deleted bundle."""
    r = _with_deployments(Roles(spark, sf))
    plan, _ = deploys.undeploy_plan(r.deployment, _deleted_bundle_requests(r), NOW)
    return plan.select(*PLAN_COLUMNS)


@query("undeploy_by_bundles", oracle=with_roles(
    UNDEPLOY_SQL.replace("SELECT DISTINCT project_id FROM req", "SELECT DISTINCT project_id FROM ask"), "deployment", "bundle", extra="""
ask AS (SELECT DISTINCT project_id, id AS bundle_id FROM bundle WHERE deletion_date IS NOT NULL),
snap AS (SELECT d.id, d.project_id, d.bundle_id, d.creation_date, a.bundle_id IS NOT NULL AND d.deactivation_date IS NULL AS changed, false AS was_deactivated,
                CASE WHEN a.bundle_id IS NOT NULL AND d.deactivation_date IS NULL THEN """ + NOW_SQL + """ ELSE d.deactivation_date END AS deactivation_date
         FROM deployment d LEFT JOIN ask a ON a.project_id = d.project_id AND a.bundle_id = d.bundle_id)"""))
def q_undeploy_by_bundles(spark, sf):
    """C-1 by bundle ids (F-3 / F-4): the active deployments of each project's deleted bundles; a project without one is an error."""
    r = _with_deployments(Roles(spark, sf))
    asked = r.bundle.filter(F.col("deletion_date").isNotNull()).select("project_id", F.col("id").alias("bundle_id"))
    none = asked.select("project_id", F.lit(None).cast("bigint").alias("dep_id")).limit(0)
    plan, _ = deploys.undeploy_plan(r.deployment, none, NOW, bundle_requests=asked)
    return plan.select(*PLAN_COLUMNS)


@query("undeploy_all", oracle=with_roles(
    UNDEPLOY_SQL.replace("SELECT DISTINCT project_id FROM req", "SELECT id AS project_id FROM project WHERE id % 2 = 0")
    .replace("coalesce(m.n_matched, 0) = 0 THEN 'error'", "false THEN 'error'"), "deployment", "project", extra="""
snap AS (SELECT id, project_id, bundle_id, creation_date, project_id % 2 = 0 AND deactivation_date IS NULL AS changed, false AS was_deactivated,
                CASE WHEN project_id % 2 = 0 THEN coalesce(deactivation_date, """ + NOW_SQL + """) ELSE deactivation_date END AS deactivation_date
         FROM deployment WHERE project_id IN (SELECT id FROM project))"""))
def q_undeploy_all(spark, sf):
    """C-1 with an empty request list: everything active of every second project goes; a project with nothing active is no error."""
    r = _with_deployments(Roles(spark, sf))
    asked = r.project.filter("id % 2 = 0").select(F.col("id").alias("project_id"), F.lit(None).cast("bigint").alias("dep_id"))
    plan, _ = deploys.undeploy_plan(r.deployment, asked, NOW, zero_undeploys_ok=True, all_if_empty=True)
    return plan.select(*PLAN_COLUMNS)


@query("undeploy_upstreams", oracle=with_roles(
    """SELECT s.project_id, b.bundle_name AS static_bundle_name, s.id AS deployment_id, d.server_instance_id AS instance_id,
              d.server_ip AS host_ip, d.server_port AS host_port
       FROM snap s JOIN deployment d ON d.id = s.id
       JOIN (SELECT project_id, arg_max(bundle_id, (creation_date, -id)) AS bundle_id FROM snap WHERE deactivation_date IS NULL GROUP BY project_id) n
         ON n.project_id = s.project_id
       LEFT JOIN bundle b ON b.id = n.bundle_id
       WHERE s.deactivation_date IS NULL AND s.project_id IN (SELECT project_id FROM req)""", "deployment", "bundle", extra=REQ_CTE))
def q_undeploy_upstreams(spark, sf):
    """C-1: the servers left to the projects that undeploy a deleted bundle, and the bundle they serve static files from."""
    r = _with_deployments(Roles(spark, sf))
    plan, snap = deploys.undeploy_plan(r.deployment, _deleted_bundle_requests(r), NOW)
    return deploys.remaining_upstreams(snap, plan, r.bundle)


@query("deactivate_snapshot", oracle=with_roles(
    "SELECT id, deactivation_date, was_deactivated, changed FROM snap", "deployment", "bundle", extra=REQ_CTE))
def q_deactivate_snapshot(spark, sf):
    """M-1: the deployment table after the undeploy (stamp now, warn if stamped)."""
    r = _with_deployments(Roles(spark, sf))
    _, snap = deploys.undeploy_plan(r.deployment, _deleted_bundle_requests(r), NOW)
    return snap.select("id", "deactivation_date", "was_deactivated", "changed")


RECOVERY_CTES = """
dead_hosts AS (SELECT * FROM host WHERE load_raw < 0),
dead AS (SELECT * FROM deployment WHERE deactivation_date IS NULL AND server_ip IN (SELECT ip FROM dead_hosts)),
per AS (SELECT project_id, count(*) AS n_dead, arg_max(bundle_id, id) AS restore_bundle_id, max(id) AS last_dead_id
        FROM dead GROUP BY project_id),
old AS (SELECT project_id, count(*) AS n_old FROM deployment WHERE deactivation_date IS NULL
        AND project_id IN (SELECT project_id FROM per) GROUP BY project_id),
live AS (SELECT *, row_number() OVER (ORDER BY instance_id) - 1 AS slot FROM host
         WHERE role = 'appserver' AND instance_id NOT IN (SELECT instance_id FROM dead_hosts)),
nl AS (SELECT count(*) AS n FROM live),
placed AS (SELECT per.project_id, count(*) AS n_new FROM per JOIN project p ON p.id = per.project_id CROSS JOIN nl
           CROSS JOIN LATERAL (SELECT unnest(range(0, least(p.num_workers, nl.n))) AS k) k GROUP BY per.project_id),
recovered AS (SELECT per.project_id, per.n_dead, per.last_dead_id, per.restore_bundle_id, b.bundle_name,
       coalesce(old.n_old, 0) AS n_old, coalesce(placed.n_new, 0) AS n_new, p.db_host,
       CASE WHEN p.id IS NULL THEN 'missing_project' WHEN b.id IS NULL THEN 'missing_bundle'
            WHEN coalesce(placed.n_new, 0) = 0 THEN 'no_appservers' ELSE 'ok' END AS status
FROM per LEFT JOIN old USING (project_id) LEFT JOIN project p ON p.id = per.project_id
LEFT JOIN bundle b ON b.id = per.restore_bundle_id LEFT JOIN placed ON placed.project_id = per.project_id)"""


@query("recovery_plan", oracle=with_roles("SELECT * FROM recovered", "deployment", "project", "bundle", "host",
                                          extra=RECOVERY_CTES))
def q_recovery_plan(spark, sf):
    """C-2 / J-3 / F-7 / F-17: recover every host reporting a negative load
    (treated as dead) at once; one restore per project."""
    r = Roles(spark, sf)
    dead_hosts = r.host.filter(F.col("load_raw") < 0)
    plan, _ = deploys.recovery_plan(r.deployment, r.project, r.bundle, r.host, dead_hosts)
    return plan


SOFT_DELETE_SQL = """
SELECT q.id, b.bundle_name,
       CASE WHEN b.id IS NULL THEN 'unknown_id' WHEN b.deletion_date IS NOT NULL THEN 'previously_deleted' ELSE 'deleted' END AS outcome,
       b.deletion_date AS previous_deletion_date,
       coalesce(b.bundle_name || '.tgz' IN (SELECT DISTINCT b2.bundle_name || '.tgz' FROM deployment d JOIN bundle b2 ON b2.id = d.bundle_id
                                            WHERE d.deactivation_date IS NULL), false) AS file_found
FROM (SELECT DISTINCT bundle_id AS id FROM deployment WHERE deactivation_date IS NOT NULL) q
LEFT JOIN bundle b ON b.id = q.id"""


@query("soft_delete_outcomes", oracle=with_roles(SOFT_DELETE_SQL, "deployment", "bundle"))
def q_soft_delete_outcomes(spark, sf):
    """M-2 + S-16: soft-delete every bundle that has been undeployed somewhere;
    ``file_found`` tells whether its archive is in the store (the archives
    of bundles with an active deployment)."""
    r = Roles(spark, sf)
    req = r.deployment.filter(F.col("deactivation_date").isNotNull()).select(F.col("bundle_id").alias("id"))
    stored = (active_filter(r.deployment, True).join(r.bundle.select(F.col("id").alias("bundle_id"), "bundle_name"), "bundle_id")
              .select(F.concat(F.col("bundle_name"), F.lit(".tgz")).alias("key")))
    _, outcomes = M.soft_delete(r.bundle, req, NOW, stored)
    return outcomes


@query("soft_delete_snapshot", oracle=with_roles(
    """SELECT b.id, CASE WHEN b.deletion_date IS NULL AND q.id IS NOT NULL THEN """ + NOW_SQL + """ ELSE b.deletion_date END AS deletion_date
       FROM bundle b LEFT JOIN (SELECT DISTINCT bundle_id AS id FROM deployment WHERE deactivation_date IS NOT NULL) q ON q.id = b.id""",
    "deployment", "bundle"))
def q_soft_delete_snapshot(spark, sf):
    """M-2: the bundle table after the soft delete (only rows without a deletion date are stamped)."""
    r = Roles(spark, sf)
    req = r.deployment.filter(F.col("deactivation_date").isNotNull()).select(F.col("bundle_id").alias("id"))
    snapshot, _ = M.soft_delete(r.bundle, req, NOW)
    return snapshot.select("id", "deletion_date")


DB_FILL_SQL = """
SELECT id, db_host IS NULL AS just_created,
       CASE WHEN db_host IS NULL THEN 'db-' || CAST(id % 9 AS VARCHAR) ELSE db_host END AS db_host,
       CASE WHEN db_host IS NULL THEN printf('p%08d', id) END AS db_name,
       CASE WHEN db_host IS NULL THEN printf('p%08d', id) END AS db_username,
       CASE WHEN db_host IS NULL THEN '' ELSE 'db_name,db_username,db_password' END AS missing,
       CASE WHEN db_host IS NULL THEN 'ok' ELSE 'error' END AS status,
       CASE WHEN database_type = 'machinery' THEN 'postgresql-gis' ELSE database_type END AS database_type
FROM project"""


@query("db_fields_fill", oracle=with_roles(DB_FILL_SQL, "project"))
def q_db_fields_fill(spark, sf):
    """M-3 / M-4 / F-9: first deployment fills the db settings; later ones need
    all four present. Projects of the ``machinery`` type require PostGIS."""
    r = Roles(spark, sf)
    p = r.project.select("id", "db_host", "database_type",
                         F.lit(None).cast("string").alias("db_name"), F.lit(None).cast("string").alias("db_username"),
                         F.lit(None).cast("string").alias("db_password"))
    filled = M.fill_db_fields(p, M.db_info_for(p))
    gis = M.mark_postgis(p, F.col("database_type") == "machinery").select("id", "database_type")
    return filled.join(gis, "id")


@query("newest_worker", oracle=with_roles(
    """SELECT project_id, arg_max(bundle_id, (creation_date, -id)) AS newest_bundle_id
       FROM deployment WHERE deactivation_date IS NULL GROUP BY project_id""", "deployment"))
def q_newest_worker(spark, sf):
    """A-5: bundle of the newest active worker per project (tie → lowest id)."""
    d = active_filter(Roles(spark, sf).deployment, True)
    return A.newest_by(d, "project_id", F.col("bundle_id")).withColumnRenamed("newest", "newest_bundle_id")


@query("served_bundle", oracle=with_roles(
    """SELECT project_id, max(bundle_id) AS bundle_id, count(DISTINCT bundle_id) AS n_bundles,
              count(DISTINCT bundle_id) > 1 AS multi
       FROM deployment WHERE deactivation_date IS NULL GROUP BY project_id""", "deployment"))
def q_served_bundle(spark, sf):
    """A-6 / A-12: served (max) bundle and distinct active bundle count."""
    s = served_bundles(Roles(spark, sf).deployment)
    return s.select("project_id", "bundle_id", "n_bundles", (F.col("n_bundles") > 1).alias("multi"))


ADD_SQL = RECOVERY_CTES + """,
asks AS (SELECT r.project_id, r.restore_bundle_id AS bundle_id, r.bundle_name, a.instance_id, a.name AS node_name, a.ip,
                row_number() OVER (PARTITION BY a.instance_id ORDER BY r.project_id) - 1 AS request_no
         FROM recovered r JOIN project p ON p.id = r.project_id CROSS JOIN nl
         CROSS JOIN LATERAL (SELECT unnest(range(0, least(p.num_workers, nl.n))) AS k) k
         JOIN live a ON a.slot = (p.id + k.k) % nl.n WHERE r.status = 'ok'),
top AS (SELECT h.instance_id, greatest(10000, coalesce(max(d.server_port), 0)) AS used
        FROM (SELECT DISTINCT instance_id FROM asks) h LEFT JOIN deployment d ON d.server_instance_id = h.instance_id AND d.deactivation_date IS NULL
        GROUP BY h.instance_id),
choice AS (SELECT instance_id, port, row_number() OVER (PARTITION BY instance_id ORDER BY port) - 1 AS request_no
           FROM (SELECT instance_id, unnest(range(used + 1, 25001)) AS port FROM top) c
           WHERE NOT EXISTS (SELECT 1 FROM deployment d WHERE d.server_instance_id = c.instance_id AND d.server_port = c.port AND d.deactivation_date IS NOT NULL)),
given AS (SELECT asks.*, CAST(choice.port AS INTEGER) AS port FROM asks JOIN choice USING (instance_id, request_no)),
added AS (SELECT (SELECT max(id) FROM deployment) + row_number() OVER (ORDER BY project_id, bundle_id, instance_id) AS id,
                 project_id, bundle_id, instance_id AS server_instance_id, ip AS server_ip, port AS server_port,
                 """ + NOW_SQL + """ AS creation_date, CAST(NULL AS TIMESTAMP) AS deactivation_date FROM given)"""


def _recovered(r):
    dead_hosts = r.host.filter(F.col("load_raw") < 0)
    _, new_rows = deploys.recovery_plan(r.deployment, r.project, r.bundle, r.host, dead_hosts)
    return deploys.recovery_workers(r.deployment, new_rows)


@query("recovery_new_workers", oracle=with_roles("SELECT * FROM added", "deployment", "project", "bundle", "host", extra=ADD_SQL))
def q_recovery_new_workers(spark, sf):
    """S-4 + C-2: the deployment rows a recovery appends (active, stamped now,
    dense ids after the table's max id), each on a free port of its host."""
    r = Roles(spark, sf)
    return M.add_workers(r.deployment, _recovered(r).filter(F.col("status") == "ok"), NOW)


@query("recovery_routes", oracle=with_roles(
    "SELECT project_id, bundle_name, instance_id, node_name, ip AS host_ip, port AS host_port FROM given",
    "deployment", "project", "bundle", "host", extra=ADD_SQL))
def q_recovery_routes(spark, sf):
    """C-2: the upstream rows of every recovered project."""
    return deploys.recovery_routes(_recovered(Roles(spark, sf)))
