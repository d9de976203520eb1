"""Undeploy plan (C-1) and host recovery plan (C-2), set-wide.

Both compose the filters, joins, aggregates and row changes of
``opsframe.operators``; no list ever leaves Spark. Per-project results are
aggregated with partial aggregation; row-level outputs (matched deployments,
new placements) stay rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.operators.filters import active_filter
from opsframe.operators.joins import placement, zip_by_position
from opsframe.operators.mutations import stamp
from opsframe.operators.windows import keyed_index
from opsframe.plans.inventory import free_ports


def undeploy_plan(deployment: DataFrame, requests: DataFrame, now, zero_undeploys_ok: bool = False,
                  bundle_requests: DataFrame | None = None, all_if_empty: bool = False) -> tuple[DataFrame, DataFrame]:
    """C-1 for every requesting project at once.

    ``requests``: (project_id, dep_id) — deployments to drop, inactive ones
    included (J-4). A row with a null ``dep_id`` is a project's empty request
    list: everything active with ``all_if_empty``, else the project is
    ``rejected``. ``bundle_requests``: (project_id, bundle_id) — the other
    route: the project's *active* deployments of those bundles (F-3/F-4).
    Returns (per-project plan, new deployment snapshot).

    Each deployment is tagged once (matched or not); the plan is one
    aggregation of the tagged rows of the requesting projects, the snapshot is
    the tagged rows themselves. Plan columns: project_id, n_matched, n_warnings
    (already inactive, F-16), n_remaining (active after the change), action
    (``update`` / ``remove`` / ``rejected`` / ``error`` when nothing matched and
    zero undeploys are not ok) and static_bundle_id (bundle of the newest
    remaining worker, A-5).
    """
    asked = requests.groupBy("project_id", F.col("dep_id").alias("id")).agg(F.lit(True).alias("__by_id"))
    tagged = deployment.join(asked.filter(F.col("id").isNotNull()), ["project_id", "id"], "left")
    projects = requests.groupBy("project_id").agg(F.max(F.col("dep_id").isNull()).alias("empty"), F.count("dep_id").alias("__n"))
    hit = F.coalesce(F.col("__by_id"), F.lit(False))
    active = F.col("deactivation_date").isNull()
    if bundle_requests is not None:
        by_bundle = bundle_requests.select("project_id", "bundle_id").distinct().withColumn("__by_bundle", F.lit(True))
        tagged = tagged.join(by_bundle, ["project_id", "bundle_id"], "left")
        hit = hit | (F.coalesce(F.col("__by_bundle"), F.lit(False)) & active)
        projects = (projects.unionByName(bundle_requests.select("project_id", F.lit(False).alias("empty"), F.lit(1).cast("bigint").alias("__n")))
                    .groupBy("project_id").agg(F.max("empty").alias("empty"), F.sum("__n").alias("__n")))
    projects = projects.select("project_id", (F.col("empty") & (F.col("__n") == 0)).alias("empty"))
    if all_if_empty:
        tagged = tagged.join(projects.filter("empty"), "project_id", "left")
        hit = hit | (F.coalesce(F.col("empty"), F.lit(False)) & active)
    tagged = tagged.withColumn("changed", hit).select(*deployment.columns, "changed")
    snapshot = (tagged.withColumn("was_deactivated", F.col("changed") & F.col("deactivation_date").isNotNull())
                .withColumn("deactivation_date", F.when(F.col("changed"), stamp(now)).otherwise(F.col("deactivation_date"))))
    stays = active & ~F.col("changed")
    per = tagged.join(projects.select("project_id"), "project_id", "left_semi").groupBy("project_id").agg(
        F.count(F.when(F.col("changed"), 1)).alias("n_matched"),
        F.count(F.when(F.col("changed") & ~active, 1)).alias("n_warnings"),
        F.count(F.when(stays, 1)).alias("n_remaining"),
        F.max_by("bundle_id", F.when(stays, F.struct(F.col("creation_date"), -F.col("id")))).alias("static_bundle_id"))
    plan = projects.join(per, "project_id", "left").fillna(0, ["n_matched", "n_warnings", "n_remaining"])
    action = (F.when(F.col("empty") & F.lit(not all_if_empty), F.lit("rejected"))
              .when((F.col("n_matched") == 0) & F.lit(not zero_undeploys_ok), F.lit("error"))
              .when(F.col("n_remaining") > 0, F.lit("update")).otherwise(F.lit("remove")))
    plan = plan.withColumn("action", action).withColumn(
        "static_bundle_id", F.when((F.col("action") == "update") & (F.col("n_remaining") > 0), F.col("static_bundle_id")))
    return plan.drop("empty"), snapshot


def remaining_upstreams(snapshot: DataFrame, plan: DataFrame, bundle: DataFrame) -> DataFrame:
    """C-1: the servers an ``update`` leaves, one row each, with the name of the
    bundle whose static files the proxy serves from then on."""
    updates = (plan.filter(F.col("action") == "update").select("project_id", "static_bundle_id")
               .join(bundle.select(F.col("id").alias("static_bundle_id"), F.col("bundle_name").alias("static_bundle_name")), "static_bundle_id", "left"))
    return (active_filter(snapshot, True).join(updates, "project_id")
            .select("project_id", "static_bundle_name", F.col("id").alias("deployment_id"), F.col("server_instance_id").alias("instance_id"),
                    F.col("server_ip").alias("host_ip"), F.col("server_port").alias("host_port")))


def recovery_plan(deployment: DataFrame, project: DataFrame, bundle: DataFrame, hosts: DataFrame,
                  dead_hosts: DataFrame, project_id=None) -> tuple[DataFrame, DataFrame]:
    """C-2: recover every dead appserver at once.

    Dead workers = active deployments on a dead host's ip (F-7), optionally
    of one project (F-17, falsy = all). Per project the reference restores
    dead workers one after the other, each pass dropping what the previous
    one deployed, so the end state is one restore per project with the bundle
    of the highest dead worker id. Old instances to drop = every active worker
    of the project (the new list is forced empty). New deployments = that
    bundle on the project's placements (J-8) among live appservers.

    Returns (per-project plan, new placement rows). ``db_password`` never
    leaves the project table.
    """
    dead_ips = dead_hosts.select(F.col("ip").alias("server_ip")).distinct()
    dead = active_filter(deployment, True).join(dead_ips, "server_ip", "left_semi")
    if project_id:
        dead = dead.filter(F.col("project_id") == F.lit(project_id))
    per = dead.groupBy("project_id").agg(F.count(F.lit(1)).alias("n_dead"),
                                         F.max_by("bundle_id", "id").alias("restore_bundle_id"),
                                         F.max("id").alias("last_dead_id"))
    old = (active_filter(deployment, True).join(per.select("project_id"), "project_id", "left_semi")
           .groupBy("project_id").agg(F.count(F.lit(1)).alias("n_old")))
    p = project.select(F.col("id").alias("project_id"), "db_host", "num_workers", F.lit(True).alias("__p"))
    b = bundle.select(F.col("id").alias("restore_bundle_id"), "bundle_name", F.lit(True).alias("__b"))
    live = hosts.join(dead_hosts.select("instance_id"), "instance_id", "left_anti")
    placed, _ = placement(p.join(per.select("project_id"), "project_id", "left_semi")
                          .select(F.col("project_id").alias("id"), "num_workers"), live)
    n_new = placed.groupBy("project_id").agg(F.count(F.lit(1)).alias("n_new"))
    plan = (per.join(old, "project_id", "left").join(p, "project_id", "left").join(b, "restore_bundle_id", "left")
            .join(n_new, "project_id", "left").fillna(0, ["n_old", "n_new"]))
    status = (F.when(F.col("__p").isNull(), F.lit("missing_project"))
              .when(F.col("__b").isNull(), F.lit("missing_bundle"))
              .when(F.col("n_new") == 0, F.lit("no_appservers")).otherwise(F.lit("ok")))
    plan = plan.withColumn("status", status).select(
        "project_id", "n_dead", "last_dead_id", "restore_bundle_id", "bundle_name", "n_old", "n_new", "db_host", "status")
    restored = plan.filter(F.col("status") == "ok").select("project_id", "restore_bundle_id", "bundle_name")
    new_rows = placed.join(restored, "project_id").select(
        "project_id", F.col("restore_bundle_id").alias("bundle_id"), "bundle_name", "instance_id", "name", "ip")
    return plan, new_rows


def recovery_workers(deployment: DataFrame, new_rows: DataFrame) -> DataFrame:
    """S-4 / W-7 / J-7: a free port of its host for every new worker of a
    recovery. Ports of active deployments are taken, those of inactive ones
    blocked. A worker beyond its host's port range has status ``out_of_ports``."""
    used = active_filter(deployment, True).select(F.col("server_instance_id").alias("host"), F.col("server_port").alias("port"))
    blocked = active_filter(deployment, False).select(F.col("server_instance_id").alias("host"), F.col("server_port").alias("port"))
    asks = keyed_index(new_rows.withColumnRenamed("instance_id", "host"), ["host"], ["project_id"], "request_no")
    replies = free_ports(used, blocked, asks.groupBy("host").agg(F.count(F.lit(1)).alias("n_req")))
    return zip_by_position(asks, replies, ["host"], "request_no").select(
        "project_id", "bundle_id", "bundle_name", F.col("host").alias("server_instance_id"), F.col("name").alias("node_name"),
        F.col("ip").alias("server_ip"), F.col("port").alias("server_port"), "status")


def recovery_routes(workers: DataFrame) -> DataFrame:
    """C-2: what the proxy is told after the restore: one upstream row per new worker."""
    return workers.filter(F.col("status") == "ok").select(
        "project_id", "bundle_name", F.col("server_instance_id").alias("instance_id"), "node_name",
        F.col("server_ip").alias("host_ip"), F.col("server_port").alias("host_port"))
