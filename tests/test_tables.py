"""Exact-value cases of the reference's database-layer tests, as literal DataFrames."""

import datetime as dt

from pyspark.sql import functions as F

from opsframe.functions.naming import ROOT_DOMAIN as ROOT

from opsframe.operators import filters as Fl
from opsframe.plans import routing

DEP = "id long, project_id long, bundle_id long, server_ip string, server_port int, server_instance_id string, " \
      "creation_date timestamp, deactivation_date timestamp"
T0 = dt.datetime(2011, 3, 1)


def deployments(spark):
    # project 2: bundle 1 active, bundle 2 deactivated; project 3: one active on another ip
    return spark.createDataFrame([
        (1, 2, 1, "10.0.0.1", 10001, "i-1", T0, None),
        (2, 2, 2, "10.0.0.1", 10002, "i-1", T0, T0),
        (3, 3, 5, "10.0.0.2", 10001, "i-2", T0, None),
    ], DEP)


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_search_workers_tri_state_and_empty_list(spark):
    d = deployments(spark)
    assert ids(Fl.search_workers(d, 2)) == [1]                       # active default
    assert ids(Fl.search_workers(d, 2, [2], False)) == [2]           # inactive for bundle 2
    assert ids(Fl.search_workers(d, 2, [2], None)) == [2]            # any for bundle 2
    assert ids(Fl.search_workers(d, 2, [], True)) == [1]             # [] means no filter
    assert ids(Fl.search_workers(d, 2, None, None)) == [1, 2]


def test_cross_project_search(spark):
    d = deployments(spark)
    assert len(ids(Fl.search_allproject_workers(d, True))) == 2
    assert ids(Fl.search_allproject_workers(d, False, "10.0.0.2")) == []
    assert ids(Fl.search_allproject_workers(d, True, "10.0.0.2")) == [3]


def hosts_of(spark, slug, vhosts):
    project = spark.createDataFrame([(2, slug)], "id long, hostname_slug string")
    vh = spark.createDataFrame(vhosts, "id long, project_id long, hostname string, is_wildcard boolean")
    rows = routing.hostnames(project, vh).orderBy("branch", "pos").collect()
    return [r["hostname"] for r in rows]


def test_hostnames_two_plain(spark):
    got = hosts_of(spark, None, [(1, 2, "foo.com", False), (2, 2, "bar.com", False)])
    assert sorted(got) == ["bar.com", "foo.com", f"p00000002.{ROOT}"]
    assert got[0] == f"p00000002.{ROOT}"


def test_hostnames_wildcard_first(spark):
    got = hosts_of(spark, "", [(1, 2, "foo.com", True)])
    assert got == [f"p00000002.{ROOT}", "*.foo.com", "foo.com"]


def test_hostnames_slug_added(spark):
    assert hosts_of(spark, "myslug", []) == [f"p00000002.{ROOT}", f"myslug.{ROOT}"]


def test_lookup_status(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id long, bundle_name string")
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "bundle_name string")
    out = {r["bundle_name"]: r["status"] for r in Fl.lookup_status(table, keys, ["bundle_name"]).collect()}
    assert out == {"a": "ok", "b": "duplicate", "c": "missing"}


def test_routing_serves_max_bundle_and_flags_multi(spark):
    d = spark.createDataFrame([
        (1, 2, 7, "10.0.0.1", 10001, "i-1", T0, None),
        (2, 2, 9, "10.0.0.2", 10002, "i-2", T0, None),
        (3, 2, 9, "10.0.0.3", 10003, "i-3", T0, None),
    ], DEP)
    bundle = spark.createDataFrame([(7, "b7"), (9, "b9")], "id long, bundle_name string")
    project = spark.createDataFrame([(2, None), (4, None)], "id long, hostname_slug string")
    vh = spark.createDataFrame([], "id long, project_id long, hostname string, is_wildcard boolean")
    rt = {r["project_id"]: r for r in routing.routing_table(d, bundle, project, vh).collect()}
    assert rt[2]["status"] == "routed" and rt[2]["bundle_id"] == 9 and rt[2]["multi"] and rt[2]["n_upstreams"] == 2
    assert rt[4]["status"] == "not_deployed"
    ups = sorted(r["deployment_id"] for r in routing.routing_upstreams(d).collect())
    assert ups == [2, 3]


def test_site_config_path_variables(spark):
    bdir = F.lit("/cust/app/bundle_x")
    df = spark.createDataFrame([("{SITE_PACKAGES}/somepackage/media",), ("{SRC_PACKAGES}/something",), ("/path/to/static",)],
                               "fp string")
    got = [r["a"] for r in df.select(routing.media_alias_dest(bdir, F.col("fp")).alias("a")).collect()]
    assert got == ["/cust/app/bundle_x/lib/python2.6/site-packages/somepackage/media",
                   "/cust/app/bundle_x/src/something", "/cust/app/bundle_x/user-repo/path/to/static"]


def test_undeploy_plan_routes(spark):
    from opsframe.plans.deploys import undeploy_plan
    d = deployments(spark)   # project 2: dep 1 active (bundle 1), dep 2 inactive (bundle 2)
    by_dep = spark.createDataFrame([(2, 2)], "project_id long, dep_id long")
    plan, snap = undeploy_plan(d, by_dep, "2030-01-01 00:00:00")
    p = plan.collect()[0]
    assert (p["n_matched"], p["n_warnings"], p["n_remaining"], p["action"]) == (1, 1, 1, "update")
    assert p["static_bundle_id"] == 1
    none = spark.createDataFrame([], "project_id long, dep_id long")
    by_bundle = spark.createDataFrame([(2, 1)], "project_id long, bundle_id long")
    plan, snap = undeploy_plan(d, none, "2030-01-01 00:00:00", bundle_requests=by_bundle)
    p = plan.collect()[0]
    assert (p["n_matched"], p["n_remaining"], p["action"]) == (1, 0, "remove")
    nothing = spark.createDataFrame([(2, 99)], "project_id long, bundle_id long")
    plan, _ = undeploy_plan(d, none, "2030-01-01 00:00:00", bundle_requests=nothing)
    assert plan.collect()[0]["action"] == "error"


def test_recovery_plan_one_restore_per_project(spark):
    from opsframe.plans.deploys import recovery_plan
    d = spark.createDataFrame([
        (1, 2, 7, "10.0.0.1", 10001, "i-1", T0, None),     # dead host, project 2
        (4, 2, 8, "10.0.0.1", 10002, "i-1", T0, None),     # dead host, project 2, higher id → its bundle wins
        (5, 2, 7, "10.0.0.2", 10001, "i-2", T0, None),     # live host, project 2 (still dropped: all old go)
        (6, 3, 9, "10.0.0.1", 10003, "i-1", T0, None),     # dead host, project 3
        (7, 3, 9, "10.0.0.1", 10004, "i-1", T0, T0),       # inactive: ignored
    ], DEP)
    project = spark.createDataFrame([(2, None, 2), (3, "db-1", 1)], "id long, db_host string, num_workers int")
    bundle = spark.createDataFrame([(7, "b7"), (8, "b8"), (9, "b9")], "id long, bundle_name string")
    hosts = spark.createDataFrame([("i-1", "h1", "appserver", "10.0.0.1"), ("i-2", "h2", "appserver", "10.0.0.2"),
                                   ("i-3", "h3", "appserver", "10.0.0.3")], "instance_id string, name string, role string, ip string")
    dead = hosts.filter("instance_id = 'i-1'")
    plan, new = recovery_plan(d, project, bundle, hosts, dead)
    p = {r["project_id"]: r for r in plan.collect()}
    assert (p[2]["n_dead"], p[2]["restore_bundle_id"], p[2]["n_old"], p[2]["n_new"], p[2]["status"]) == (2, 8, 3, 2, "ok")
    assert (p[3]["n_dead"], p[3]["restore_bundle_id"], p[3]["n_new"]) == (1, 9, 1)
    assert {r["instance_id"] for r in new.collect()} <= {"i-2", "i-3"}          # never the dead host
    only3, _ = recovery_plan(d, project, bundle, hosts, dead, project_id=3)     # F-17
    assert [r["project_id"] for r in only3.collect()] == [3]
