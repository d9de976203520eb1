"""Small inputs for the operators: the sf0.001 documents, and rows with nulls, empty, long and repeated texts."""

import re

from pyspark.sql import functions as F

from tests.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
EDGES = [
    (1001, None, "en", "s", None), (1002, "", "en", None, 0), (1003, " \t\n ", None, "s", 4), (1004, "one", "en", "s", 3),
    (1005, LONG, "en", "s", len(LONG)), (1006, LONG + " end", "en", "s", None), (1007, "x" * 5000, "en", "s", 5000),
    (1008, "same words here " * 30, "en", "s", 0), (1009, "same words here " * 30, "en", "s", 0), (1009, "same words here " * 30, "en", "s", 0),
    (None, "no id " * 60, "en", "s", 0), (1010, "中文 \U0001f600 ÉtÉ İ á", "fr", "s", 0), (-5, "minus " * 80, "en", "s", 0),
    (1011, "123 456 !!! 789", "en", "s", 0),
]


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def edges(spark):
    """Rows that need care, with columns whose names operators might use themselves."""
    df = spark.createDataFrame(EDGES, SCHEMA)
    for name in ("id", "rep", "shard", "_bucket", "_same", "component", "score", "at", "copy", "host"):
        df = df.withColumn(name, F.lit("extra"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return [tuple(r) for r in df.collect()]
