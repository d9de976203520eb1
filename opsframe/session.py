"""Spark session and lineage helpers.

The library never creates its own engine: every operator takes and returns
DataFrames of the caller's session. ``get_spark`` exists for tests, the bench
and the command line; on a cluster the caller's session (and its
``spark.checkpoint.dir``) is used as it is.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings the operators rely on: UTC wall clock (every timestamp in
# the control tables is UTC), AQE for runtime coalescing and skew-join
# splitting, and Arrow for the few pandas-backed operators.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a table of very many small folders is listed by this many tasks (the default is a task a folder, up to 10,000)
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "opsframe", cpus: str | int = "*",
              shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("OPSFRAME_DRIVER_MEMORY", "8g")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder: the one already set on the
    context, else the one ``spark.checkpoint.dir`` names.

    On a cluster this must be a shared folder. Only a ``local`` session without
    one (tests, the bench) gets a scratch folder; elsewhere that is an error,
    since executors could not see the driver's folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="opsframe-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder name not used before, under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


ROWS_PER_TASK = 500_000


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df hash-partitioned by ``keys`` into tasks of about ROWS_PER_TASK of its ``rows``, whatever
    ``spark.sql.shuffle.partitions`` says, so that what a task sorts or groups doesn't grow
    with the table; a table of one task's rows is left as it is."""
    if rows <= ROWS_PER_TASK:
        return df
    n = max(-(-rows // ROWS_PER_TASK), df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(n, *keys)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives lost executors)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
