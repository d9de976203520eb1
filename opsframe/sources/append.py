"""Exactly-once appends to a table folder (S-2, S-3, S-4, S-5).

A run (one execution of a job, named by the caller) stages its rows in a folder of its own attempt and then
commits the attempt: one row in the table's manifest. A run counts once: a run that is in the manifest is not
appended again, rows of an attempt that failed before its commit are never read, and of two attempts that
commit the same run the earlier one counts for every reader.

    table/data/append_run=<run>/append_attempt=<attempt>/part-*.parquet
    table/manifest/append_run=<run>/append_attempt=<attempt>/part-*.parquet      one row: when

The manifest has one row per run, so its size follows the number of runs, not of rows. Different runs that
number their rows after the table's greatest id must follow each other (one writer at a time).
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.operators.windows import dense_index

PLACE = ["append_run", "append_attempt"]


def _folder(table: str, kind: str, run: str, attempt: str) -> str:
    return f"{table.rstrip('/')}/{kind}/{PLACE[0]}={run}/{PLACE[1]}={attempt}"


def create_table(rows: DataFrame, table: str, run: str = "created") -> None:
    """A table folder with its first rows."""
    commit(rows.sparkSession, table, run, stage(rows, table, run))


def stage(rows: DataFrame, table: str, run: str) -> str:
    """Write the rows of an attempt; not visible until it is committed."""
    attempt = uuid.uuid4().hex
    rows.write.parquet(_folder(table, "data", run, attempt))
    return attempt


def commit(spark: SparkSession, table: str, run: str, attempt: str) -> None:
    spark.createDataFrame([(time.time_ns(),)], "at long").coalesce(1).write.parquet(_folder(table, "manifest", run, attempt))


def committed_attempts(spark: SparkSession, table: str) -> DataFrame:
    """The attempt of each run that counts."""
    manifest = spark.read.schema("at long, append_run string, append_attempt string").parquet(f"{table.rstrip('/')}/manifest")
    return manifest.groupBy("append_run").agg(F.min(F.struct("at", "append_attempt")).alias("first")).select("append_run", "first.append_attempt")


def read_table(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """The committed rows; folders of other attempts are skipped by their names."""
    rows = spark.read.schema(f"{schema}, append_run string, append_attempt string").parquet(f"{table.rstrip('/')}/data")
    return rows.join(committed_attempts(spark, table), PLACE, "left_semi").drop(*PLACE)


def append_once(rows: DataFrame, table: str, run: str) -> bool:
    """Append the rows of a run; False if the run is there already (nothing is written)."""
    spark = rows.sparkSession
    if not committed_attempts(spark, table).filter(F.col("append_run") == run).isEmpty():
        return False
    commit(spark, table, run, stage(rows, table, run))
    return True


def append_numbered(rows: DataFrame, table: str, run: str, schema: str, order: list[str], id_col: str = "id") -> bool:
    """``append_once`` of rows without an id: they get dense ids after the table's greatest, in ``order`` (W-8)."""
    spark = rows.sparkSession
    if not committed_attempts(spark, table).filter(F.col("append_run") == run).isEmpty():
        return False
    start = read_table(spark, table, schema).agg(F.max(id_col)).first()[0] or 0
    numbered = dense_index(rows, order, id_col, start=start + 1)
    names = [c.split()[0] for c in schema.split(", ")]
    commit(spark, table, run, stage(numbered.select(*names), table, run))
    return True
