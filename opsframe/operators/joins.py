"""Joins (J-1 .. J-15). Every lookup the reference does row by row (N+1) is
one equi-join here; Catalyst/AQE picks broadcast or sort-merge at run time
from the measured side sizes. Explicit ``broadcast`` is used only for sides
whose size is fixed by construction (literal dimensions, one row per
partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.operators.windows import dense_index


def scalar(one_row: DataFrame):
    """Value of a one-row, one-column global aggregate (a count, a max). Read
    once on the driver — a single number, not data — and used as a literal,
    so the plan needs no join (a constant-key join would be folded into a
    nested-loop cross join)."""
    row = one_row.first()
    return None if row is None else row[0]


def worker_bundle(deployment: DataFrame, bundle: DataFrame) -> DataFrame:
    """J-2: deployment → its bundle (N:1 inner equi-join)."""
    b = bundle.select(F.col("id").alias("bundle_id"), "bundle_name", F.col("project_id").alias("bundle_project_id"))
    return deployment.join(b, "bundle_id")


def old_instances(active: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """J-5 / U-5: instances active before a deploy that are not among the new ones."""
    return active.join(new.select(key), key, "left_anti")


def queue_routing(work_items: DataFrame, hosts: DataFrame) -> DataFrame:
    """J-10: hosts subscribe to comma-separated queues; per task, how many
    hosts consume its queue (0 = nobody will run it).

    Subscriber counts are pre-aggregated per queue before the join, so a
    queue everyone subscribes to costs one row, and no task × host pairs
    are formed.
    """
    subs = (hosts.select(F.explode(F.split("queues", ",")).alias("queue"))
            .groupBy("queue").agg(F.count(F.lit(1)).alias("n_subscribers")))
    out = work_items.join(subs, "queue", "left").withColumn("n_subscribers", F.coalesce("n_subscribers", F.lit(0)))
    return out.withColumn("routed", F.col("n_subscribers") > 0)


def placement(project: DataFrame, hosts: DataFrame, workers: str = "num_workers") -> DataFrame:
    """J-8 (re-aimed, see README): appservers for every app.

    The reference places every app on every configured appserver (one
    ``localhost`` by default). All-pairs output is not built: each app gets
    ``min(num_workers, n_appservers)`` distinct appservers, taken round-robin
    from an offset given by the app id — with one appserver this equals the
    reference. Implemented as an equi-join on a slot index:
    appservers get a dense index (W-8, no global window) and each app
    explodes its own bounded slot list. An app with no appserver at all gets
    a ``no_appservers`` error row.
    """
    app_hosts = dense_index(hosts.filter(F.col("role") == "appserver"), ["instance_id"], "slot")
    # one row (a proven size bound), attached by a broadcast equi-join on a constant
    p = project.withColumn("n_hosts", F.lit(scalar(app_hosts.agg(F.count(F.lit(1))))).cast("bigint"))
    k = F.least(F.col(workers), F.col("n_hosts"))
    slots = p.select(F.col("id").alias("project_id"), "n_hosts",
                     F.explode(F.when(k > 0, F.sequence(F.lit(0), (k - 1).cast("int")))
                               .otherwise(F.array().cast("array<int>"))).alias("k"))
    slots = slots.withColumn("slot", ((F.col("project_id") + F.col("k")) % F.col("n_hosts")).cast("bigint"))
    placed = (slots.join(app_hosts.select("slot", "instance_id", "name", "ip"), "slot")
              .drop("n_hosts").withColumn("status", F.lit("ok")))
    errors = (p.filter(F.coalesce(F.col("n_hosts"), F.lit(0)) == 0)
              .select(F.col("id").alias("project_id"), F.lit("no_appservers").alias("status")))
    return placed, errors


def zip_by_position(requests: DataFrame, replies: DataFrame, keys: list[str], pos: str = "request_no") -> DataFrame:
    """J-7: positional zip of requests and replies as an inner join on an
    explicit request number (the reference zips two Python lists)."""
    return requests.join(replies, [*keys, pos])


SHORTEST_SUFFIX = 4


def path_tails(left: DataFrame, right: DataFrame, group: str, suffix_col: str, path_col: str, shortest: int = SHORTEST_SUFFIX) -> DataFrame:
    """J-9: the ends of ``right``'s paths that may equal a suffix of ``left`` in the same
    group: (group, tail, path and the other columns of ``right``).

    Two strings that end alike have equal last characters, so the lengths of a group's
    suffixes are looked up by (group, last ``shortest`` characters) - one row a key - and a
    path is cut to just these lengths. Suffixes have at least ``shortest`` characters (a
    module's file is at least ``x.py``); a shorter one is an error."""
    s, p = F.col(suffix_col), F.col(path_col)
    long_enough = F.when(F.length(s) < shortest, F.raise_error(F.concat(F.lit("suffix too short: "), s)).cast("string")).otherwise(F.right(s, F.lit(shortest)))
    lengths = left.select(F.col(group).alias("__g"), long_enough.alias("__end"), F.length(s).alias("__len")).groupBy("__g", "__end").agg(
        F.collect_set("__len").alias("__lengths"))
    cut = right.withColumn("__g", F.col(group)).withColumn("__end", F.right(p, F.lit(shortest))).join(lengths, ["__g", "__end"])
    return (cut.withColumn("__l", F.explode("__lengths")).filter(F.col("__l") <= F.length(p))
            .withColumn("tail", F.right(p, F.col("__l"))).drop("__g", "__end", "__lengths", "__l"))


def suffix_join(left: DataFrame, right: DataFrame, group: str, suffix_col: str, path_col: str) -> DataFrame:
    """J-9: rows of ``right`` in the same ``group`` whose ``path_col`` ends with
    ``left.suffix_col`` (no ``/`` boundary, as in the reference): an equi-join on
    (group, the path's end), see ``path_tails``; only matching pairs meet."""
    tails = path_tails(left, right, group, suffix_col, path_col).withColumnRenamed("tail", suffix_col)
    return left.join(tails, [group, suffix_col])


def first_suffix_match(left: DataFrame, right: DataFrame, group: str, suffix_col: str, path_col: str, out: str) -> DataFrame:
    """J-9 when only the first (least) path counts: it is picked per (group, end) before
    the join, so equal settings and many matching files make no pairs."""
    firsts = (path_tails(left, right.select(group, path_col), group, suffix_col, path_col)
              .groupBy(group, F.col("tail").alias(suffix_col)).agg(F.min(path_col).alias(out)))
    return left.join(firsts, [group, suffix_col])


def dangling_links(links: DataFrame, paths: DataFrame, target: str = "target", path: str = "path",
                   group: str = "repo_id") -> DataFrame:
    """J-12: link rows whose target path does not exist in the same tree."""
    existing = paths.select(group, F.col(path).alias(target))
    return links.join(existing, [group, target], "left_anti")


def version_lookup(projects: DataFrame, versions: DataFrame, key: str = "django_version") -> DataFrame:
    """J-15: version → install line; unknown version → status ``unknown_version``.
    ``versions`` is a fixed literal dimension (a handful of rows), so it is
    broadcast by construction."""
    out = projects.join(F.broadcast(versions), key, "left")
    return out.withColumn("status", F.when(F.col("install_line").isNull(), F.lit("unknown_version"))
                          .otherwise(F.lit("ok")))
