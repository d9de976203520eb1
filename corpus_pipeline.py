"""A corpus pipeline of training-data operators, each stage written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm import decontaminate, langid, minhash, packing, pii
from opsframe.llm.common import fresh, saved, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those whose calibrated score lies below the model's floor, which is
    set on labelled texts that trained nothing. Where no row has a label, every text with a letter stays. Null
    texts go; rows are judged one by one, so null, shared and repeated ids make no difference. An empty table
    stays empty; columns lang_pred and score of the input are lost, as predict replaces them."""
    model = langid.train(docs.where(~langid.held_out()))
    if not model.labels:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return langid.predict(docs, model).where((F.col("lang_pred") != "und") & (F.col("score") >= model.floor)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the least id: five-word shingles,
    similarity from 0.8 on. Texts without words stay; of rows equal in id and text one stays. Rows are judged by id
    and text: a shared id takes no other text with it, and of near duplicates without any id one stays."""
    return minhash.one_of_each(docs, k=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go. A row is known by its id and text together, so rows without an id are
    judged too and a row that shares its id with a leak stays if its own text is clean. Null texts stay. Without
    benchmark items every row stays."""
    key = F.xxhash64(F.col("doc_id"), F.col("text"))
    rows = docs.withColumn(row := fresh(docs, "_row"), key)
    found = decontaminate.leaks(docs.select(key.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return rows.join(found.select(F.col("doc_id").alias(row)).distinct(), row, "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind; n_chars counts the new text (null for a null text).
    Every row stays, whatever its id."""
    return pii.redact(docs, pii.train(docs), "text", "n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining texts in windows of tokens, one row per piece; null and empty texts are their end token.
    Rows that share an id are packed each; an empty table gives no pieces."""
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("personal_data", personal_data),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
