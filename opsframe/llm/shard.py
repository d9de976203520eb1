"""Sharding by a two-pass external shuffle.

Pass one scatters the records uniformly over memory-sized buckets by a seeded hash of their id and
text, in one Spark shuffle. Pass two orders each bucket by (id, text) - so that a retried task starts from the same
rows - and applies a Fisher-Yates shuffle seeded by the bucket. Buckets laid end to end are the new
order; shard i takes the positions from floor(i*n/shards), so row counts differ by one at most (law
``rows``), and a bucket can be written by the task that shuffled it.

Rows that share an id, or have none, are scattered by their texts; only rows equal in both share a bucket. Null texts have no bytes.
An empty table gives no rows. Other columns travel along; those named like a result column are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.llm.common import fresh

SEED = 20240229
BUCKET_MB = 16


def _swaps(n: int, rng: np.random.Generator) -> np.ndarray:
    """Fisher-Yates: from the last position down, swap with a uniform position at or before it."""
    order = list(range(n))
    picks = (rng.random(n) * np.arange(1, n + 1)).astype(np.int64).tolist()
    for i in range(n - 1, 0, -1):
        j = picks[i]
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def two_pass_shuffle(df: DataFrame, shards: int, seed: int = SEED, bucket_mb: int = BUCKET_MB,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df in a random order: its columns and shard (int), slot (long, gapless from 0 in each shard)."""
    df = df.drop("shard", "slot")
    bucket_col, place_col = fresh(df, "_bucket"), fresh(df, "_position")
    n_rows, n_bytes = df.agg(F.count(F.lit(1)), F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + 64)).first()
    buckets = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(n_bytes or 0) // (bucket_mb << 20)))
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)), F.lit(buckets)).cast("int")
    # one row per bucket: how many rows lie before it
    before = (df.groupBy(bucket.alias(bucket_col)).agg(F.count(F.lit(1)).alias("_n"))
              .select(bucket_col, (F.sum("_n").over(Window.orderBy(bucket_col)) - F.col("_n")).alias("_before")))
    scattered = df.withColumn(bucket_col, bucket)
    schema = T.StructType([*scattered.schema.fields, T.StructField(place_col, T.LongType())])

    def shuffled(key: tuple, rows: pa.Table, offset: pa.Table) -> pa.Table:
        rows = rows.sort_by([(id_col, "ascending"), (text_col, "ascending")])
        order = _swaps(rows.num_rows, np.random.default_rng([seed, key[0].as_py()]))
        start = offset.column("_before")[0].as_py()
        return rows.take(order).append_column(place_col, pa.array(np.arange(start, start + rows.num_rows)))

    position = F.col(place_col)
    shard = F.floor(((position + 1) * shards - 1) / F.lit(max(n_rows, 1)))  # exact below 2**53 / shards
    first = F.floor(shard * F.lit(n_rows) / shards)
    # the offsets come to the buckets' tasks, so the records are shuffled once
    return (scattered.groupBy(bucket_col).cogroup(before.groupBy(bucket_col)).applyInArrow(shuffled, schema)
            .withColumns({"shard": shard.cast("int"), "slot": (position - first).cast("long")})
            .drop(bucket_col, place_col))


def write_shards(shuffled: DataFrame, path: str) -> None:
    """One folder per shard; each bucket's task writes its own rows, in slot order, without a further shuffle."""
    shuffled.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_digest(documents: DataFrame, shards: int = 24, seed: int = SEED) -> DataFrame:
    out = two_pass_shuffle(documents.select("doc_id", "text"), shards, seed)
    return out.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
