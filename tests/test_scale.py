"""Steps whose tasks must not grow with the tables."""

import pytest
from pyspark.sql import functions as F

from opsframe import session
from opsframe.driver import routing, tables
from opsframe.plans import projectcfg
from opsframe.sources.roles import Roles

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def small_tasks(monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 500)


def most_rows(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_deployments_are_grouped_in_tasks_of_bounded_rows(spark, small_tasks, monkeypatch):
    spread = Roles(spark, SF).deployment
    assert spread.rdd.getNumPartitions() == -(-Roles(spark, SF).lineitem.count() // 500)
    assert most_rows(spread) < 1000
    monkeypatch.setattr(session, "ROWS_PER_TASK", 10**9)
    plain = Roles(spark, SF).deployment
    assert spread.exceptAll(plain).count() == plain.exceptAll(spread).count() == 0


def test_two_key_lookup_is_told_apart_in_tasks_of_bounded_rows(spark, small_tasks, monkeypatch):
    spread = tables.q_lookup_two_key(spark, SF)
    assert most_rows(spread) < 1000
    monkeypatch.setattr(session, "ROWS_PER_TASK", 10**9)
    plain = tables.q_lookup_two_key(spark, SF)
    assert spread.exceptAll(plain).count() == plain.exceptAll(spread).count() == 0


def test_rows_that_become_site_files_are_spread(spark, small_tasks):
    lines = routing.q_site_config_text(spark, SF)
    n = lines.filter("section = 0").count()
    assert most_rows(lines.filter("section = 0")) < n / 3


def test_requirement_files_are_not_broadcast(spark):
    files = spark.createDataFrame([(1, "a.txt", 0, "-r b.txt"), (1, "b.txt", 0, "six"), (1, "b.txt", 1, "-r a.txt"), (2, "a.txt", 0, "-r c.txt")],
                                  "project_id long, file string, line_no int, line string")
    top = spark.createDataFrame([(1, "a.txt", 0), (2, "a.txt", 0)], "project_id long, file string, file_order int")
    lines = projectcfg.requirement_lines(files, top)
    assert sorted((r["project_id"], r["line"], r["status"]) for r in lines.collect()) == [
        (1, "a.txt", "include_cycle"), (1, "six", "ok"), (2, "c.txt", "unreadable")]
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
