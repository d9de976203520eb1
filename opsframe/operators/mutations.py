"""Row changes (M-1 .. M-4) as pure functions ``(snapshot, changes) → snapshot``.

Parquet has no UPDATE; each operator returns the new snapshot plus, where the
reference logs or raises, an outcome/warning column. ``now`` is a parameter
(the job's run time) so a rerun after a lost executor gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsframe.functions import naming
from opsframe.operators.filters import missing_fields

DB_FIELDS = ("db_host", "db_name", "db_username", "db_password")
POSTGIS_TYPE = "postgresql-gis"


def stamp(now) -> Column:
    return now if isinstance(now, Column) else F.lit(now).cast("timestamp_ntz")


def soft_delete(bundle: DataFrame, requested_ids: DataFrame, now, stored: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """M-2 + S-16: soft-delete requested bundles.

    Returns (new bundle snapshot, outcome rows). ``deletion_date`` is set only
    when null. Outcomes per request: ``deleted``, ``previously_deleted``
    (warning) or ``unknown_id`` (the reference raises on it); ``file_found``
    tells whether ``<bundle_name>.tgz`` is in the store listing ``stored``
    (one ``key`` column) — the store delete is a side effect not done here.
    """
    req = requested_ids.select(F.col("id")).distinct()
    b = bundle.select("id", "bundle_name", "deletion_date")
    j = req.join(b.withColumn("__known", F.lit(True)), "id", "left")
    outcome = (F.when(F.col("__known").isNull(), F.lit("unknown_id"))
               .when(F.col("deletion_date").isNotNull(), F.lit("previously_deleted"))
               .otherwise(F.lit("deleted")))
    outcomes = j.select("id", "bundle_name", outcome.alias("outcome"),
                        F.col("deletion_date").alias("previous_deletion_date"))
    if stored is not None:
        keys = stored.select(F.col("key").alias("__key"), F.lit(True).alias("file_found")).distinct()
        outcomes = (outcomes.join(keys, F.concat(F.col("bundle_name"), F.lit(".tgz")) == F.col("__key"), "left")
                    .withColumn("file_found", F.coalesce("file_found", F.lit(False))).drop("__key"))
    hit = bundle.join(req.withColumn("__r", F.lit(True)), "id", "left")
    snapshot = (hit.withColumn("deletion_date", F.when(F.col("__r") & F.col("deletion_date").isNull(), stamp(now))
                               .otherwise(F.col("deletion_date"))).drop("__r"))
    return snapshot, outcomes


def mark_postgis(project: DataFrame, requires: Column) -> DataFrame:
    """M-3: ``database_type = postgresql-gis`` where ``requires`` holds."""
    return project.withColumn("database_type", F.when(requires, F.lit(POSTGIS_TYPE)).otherwise(F.col("database_type")))


def fill_db_fields(project: DataFrame, dbinfo: DataFrame) -> DataFrame:
    """M-4 + F-9: first deployment (``just_created``) copies the new database
    settings into the project; otherwise the project must already hold all
    four settings (empty string counts as missing) and they are used as-is,
    else the row is an ``error`` naming the missing fields.

    ``dbinfo``: (project_id, host, db_name, username, password, just_created).
    The password column is dropped from the output (never written anywhere).
    """
    d = dbinfo.withColumnRenamed("project_id", "id")
    j = project.join(d, "id", "left")
    created = F.coalesce(F.col("just_created"), F.lit(False))
    filled = j.select(
        "id", created.alias("just_created"),
        F.when(created, F.col("host")).otherwise(F.col("db_host")).alias("db_host"),
        F.when(created, F.col("db_name_new")).otherwise(F.col("db_name")).alias("db_name"),
        F.when(created, F.col("username")).otherwise(F.col("db_username")).alias("db_username"),
        F.when(created, F.col("password")).otherwise(F.col("db_password")).alias("db_password"))
    missing = F.when(~F.col("just_created"), missing_fields(*DB_FIELDS))
    return (filled.withColumn("missing", F.array_join(F.coalesce(missing, F.array().cast("array<string>")), ","))
            .withColumn("status", F.when(F.col("missing") == "", F.lit("ok")).otherwise(F.lit("error")))
            .drop("db_password"))


def db_info_for(project: DataFrame) -> DataFrame:
    """The database a first deployment creates: named after the app's system id."""
    return project.select(F.col("id").alias("project_id"),
                          F.concat(F.lit("db-"), (F.col("id") % 9).cast("string")).alias("host"),
                          naming.sysid("id").alias("db_name_new"), naming.sysid("id").alias("username"),
                          F.lit(None).cast("string").alias("password"),
                          F.col("db_host").isNull().alias("just_created"))


def add_workers(deployment: DataFrame, new: DataFrame, now) -> DataFrame:
    """S-4: append new deployments: dense ids after the table's max id (W-8,
    ordered by project, bundle, host), created ``now``, active (no
    deactivation stamp). ``new``: (project_id, bundle_id, server_instance_id,
    server_ip, server_port)."""
    from opsframe.operators.joins import scalar
    from opsframe.operators.windows import dense_index

    start = scalar(deployment.agg(F.max("id"))) or 0
    numbered = dense_index(new, ["project_id", "bundle_id", "server_instance_id"], "__i")
    return numbered.select(
        (F.lit(start) + F.col("__i") + 1).cast("bigint").alias("id"), "project_id", "bundle_id",
        "server_instance_id", "server_ip", F.col("server_port").cast("int").alias("server_port"),
        stamp(now).alias("creation_date"), F.lit(None).cast("timestamp_ntz").alias("deactivation_date"))


def store_catalog(bundle: DataFrame, stored: DataFrame) -> DataFrame:
    """S-16: bundle store catalog: bundle rows ⟗ stored objects on
    ``<bundle_name>.tgz``. ``present`` (both), ``missing`` (row, no object —
    a get would fail), ``orphan`` (object, no row); deleted bundles whose
    object is gone are ``deleted``."""
    b = bundle.select("id", "bundle_name", "deletion_date", F.concat(F.col("bundle_name"), F.lit(".tgz")).alias("key"))
    s = stored.select("key").distinct().withColumn("__s", F.lit(True))
    j = b.join(s, "key", "full_outer")
    status = (F.when(F.col("id").isNull(), F.lit("orphan"))
              .when(F.col("__s").isNotNull(), F.lit("present"))
              .when(F.col("deletion_date").isNotNull(), F.lit("deleted"))
              .otherwise(F.lit("missing")))
    return j.select("key", "id", status.alias("status"))
