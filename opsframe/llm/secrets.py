"""Secret scans with a random forest for false-positive removal, in DataFrame, SQL and ML functions only.

1. A high-recall pattern finds candidates: what is assigned to a secret's name, from NAMED characters on and of any
   characters but white space, quotes and separators; and runs of at least MIN_LENGTH key characters that hold a
   digit or stand after an assignment or a word that speaks of secrets.
2. Each has features: length, shares of character classes, changes between classes, distinct characters and
   entropy, the part covered by dictionary words, path form, and words beside it. The dictionary is
   every run of three letters or more that stands in at least DICTIONARY and one in SPREAD of all different texts,
   so copies of a text don't make its own secret a word.
3. Findings are labelled by rules that are sure: known key formats, and assignments to a secret's name, are
   secrets; plain numbers, paths, UUIDs and what stands after the name of a checksum or id are not.
   The others have no label. A random forest is trained on a sample of at most about SAMPLE labelled findings
   per label, by a hash of id and place, and scores all findings; from THRESHOLD on one is kept.

Null texts have no findings. Rows that share an id are texts of their own, told apart by a hash of the text;
equal rows repeat their findings. An empty table gives no rows. If all labels are alike or there are none,
the label (unlabelled: 0) is the score.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.llm.common import saved

MIN_LENGTH = 16
NAMED = 6
DICTIONARY, SPREAD = 3, 2000
SAMPLE = 10_000
THRESHOLD = 0.5
TREES, DEPTH, SEED = 24, 6, 13

# Patterns of candidates, key formats and neighbouring words
KEY = "[A-Za-z0-9_+/=~.-]"
NAME = "(?i:token|secret|passw(?:or)?d|passwd|passphrase|pwd|api.?key|access.?key|private.?key|auth|credentials?|client.?key)"
ASSIGNED = f"(?<=[=:]\\s{{0,3}}[\"']?)(?<={NAME}[A-Za-z0-9_]{{0,8}}[\"']?\\s{{0,3}}[=:]\\s{{0,3}}[\"']?)(?<![^\\s=:\"'])[^\\s\"',;<>=:][^\\s\"',;<>]{{{NAMED - 1},}}"
CANDIDATE = f"(?:{ASSIGNED}|(?<!{KEY}){KEY}{{{MIN_LENGTH},}})"
FORMATS = "^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+)$"
SECRET_WORDS = "(?i)(token|secret|passw|pwd|api.?key|access.?key|private.?key|auth|bearer|credential|client.?key)"
PLAIN_WORDS = "(?i)(sha.?[0-9]+|md5|checksum|digest|commit|revision|uuid|guid|etag|isbn|version|order|invoice)"
UUID = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
PATH = "^([.~]{0,2}/)?([A-Za-z0-9_.~-]+/)+[A-Za-z0-9_.~-]*$"

FEATURES = ("length", "digits", "uppers", "lowers", "marks", "changes", "distinct_chars", "entropy", "covered",
            "slashes", "path_form", "hex_form", "decimal_form", "assigned", "quoted", "secret_word", "plain_word")


def _sql(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def candidates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, textkey, start (code points), found, before, after: every candidate with 48 characters beside it."""
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(f"text rlike '{_sql(CANDIDATE)}'")
    # what lies between the matches is one piece longer than the matches
    parts = (docs.withColumn("hits", F.expr(f"regexp_extract_all(text, '{_sql(CANDIDATE)}', 0)"))
             .withColumn("gaps", F.expr(f"split(text, '{_sql(CANDIDATE)}', -1)"))
             .withColumn("ends", F.expr("""aggregate(arrays_zip(gaps, hits), cast(array() as array<bigint>),
                 (a, x) -> concat(a, array(coalesce(try_element_at(a, -1), 0L) + char_length(x.gaps) + coalesce(char_length(x.hits), 0))))""")))
    each = parts.select("doc_id", F.xxhash64("text").alias("textkey"), F.expr("""inline(transform(hits, (x, i) -> named_struct(
        'start', get(ends, i) - char_length(x), 'found', x,
        'before', right(get(gaps, i), 48), 'after', left(get(gaps, i + 1), 48))))"""))
    return each.where(f"found rlike '[0-9]' or before rlike '{_sql('[=:]')}\\\\s*[\"\\']?$' or before rlike '{_sql(SECRET_WORDS)}'")


def dictionary(documents: DataFrame, text_col: str = "text", least: int = DICTIONARY, spread: int = SPREAD) -> DataFrame:
    """word: lower-cased runs of three letters or more that stand in enough different texts; copies count once."""
    texts = documents.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.xxhash64(text_col).alias("key"))
    enough = F.greatest(F.lit(least), F.ceil(F.lit(texts.agg(F.count_distinct("key")).first()[0]) / spread))
    words = texts.dropDuplicates(["key"]).select(F.explode(F.array_distinct(F.expr("regexp_extract_all(lower(text), '(?<![a-z0-9])[a-z]{3,}(?![a-z0-9])', 0)"))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= enough).select("word")


def described(found: DataFrame, words: DataFrame) -> DataFrame:
    """found with FEATURES and label (1, 0 or null)."""
    key = ["doc_id", "textkey", "start"]
    pieces = found.dropDuplicates(key).select(*key, F.explode(F.expr("array_distinct(regexp_extract_all(lower(found), '[a-z]{3,}', 0))")).alias("word"), "found")
    covered = (pieces.join(words, "word").groupBy(*key)
               .agg(F.sum(F.expr("char_length(found) - char_length(replace(lower(found), word, ''))")).alias("covered_chars")))
    share = lambda pattern: F.expr(f"char_length(regexp_replace(found, '{pattern}', '')) / char_length(found)")
    flag = lambda column, pattern: F.expr(f"cast({column} rlike '{_sql(pattern)}' as double)")
    joined = found.join(covered.withColumnRenamed("doc_id", "_id").withColumnRenamed("textkey", "_key").withColumnRenamed("start", "_start"),
                        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("textkey") == F.col("_key")) & (F.col("start") == F.col("_start")), "left")
    out = joined.withColumns({
        "length": F.char_length("found").cast("double"),
        "digits": share("[^0-9]"), "uppers": share("[^A-Z]"), "lowers": share("[^a-z]"), "marks": share("[A-Za-z0-9]"),
        "changes": F.expr("char_length(regexp_replace(regexp_replace(regexp_replace(regexp_replace(found, '[0-9]+', '0'), '[a-z]+', 'a'), '[A-Z]+', 'A'), '[^0aA]+', '-')) / char_length(found)"),
        "distinct_chars": F.expr("cast(size(array_distinct(split(found, ''))) as double)"),
        "entropy": F.expr("""aggregate(array_distinct(split(found, '')), 0D, (s, c) -> s -
            (char_length(found) - char_length(replace(found, c, ''))) / char_length(found) * log2(greatest(char_length(found) - char_length(replace(found, c, '')), 1) / char_length(found)))"""),
        "covered": F.coalesce(F.col("covered_chars"), F.lit(0)) / F.char_length("found"),
        "slashes": F.expr("cast(char_length(found) - char_length(replace(found, '/', '')) as double)"),
        "path_form": flag("found", PATH), "hex_form": flag("found", "^([0-9a-f]+|[0-9A-F]+)$"), "decimal_form": flag("found", "^[0-9.+-]+$"),
        "assigned": flag("before", "[=:]\\s*[\"']?$"), "quoted": flag("before", "[\"']$"),
        "secret_word": flag("right(before, 32)", SECRET_WORDS), "plain_word": flag("right(before, 32)", PLAIN_WORDS)})
    label = (F.when(F.expr(f"found rlike '{_sql(FORMATS)}'"), 1.0)
             .when((F.col("assigned") == 1) & (F.col("secret_word") == 1) & (F.col("decimal_form") == 0) & (F.col("entropy") > 2.5) & (F.col("covered") < 0.8), 1.0)
             .when((F.col("decimal_form") == 1) | F.expr(f"found rlike '{UUID}'") | ((F.col("path_form") == 1) & (F.col("secret_word") == 0)), 0.0)
             .when((F.col("plain_word") == 1) & (F.col("secret_word") == 0), 0.0)
             .when((F.col("covered") >= 0.8) & (F.col("assigned") == 0), 0.0)
             .when((F.col("secret_word") == 0) & (F.col("assigned") == 0), 0.0))
    return out.withColumn("label", label).select(*key, "found", *FEATURES, "label")


def scored(findings: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """findings with score (0 to 1), by a forest trained on a bounded sample of the labelled ones."""
    counts = {r[0]: r[1] for r in findings.where("label is not null").groupBy("label").count().collect()}
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="_vector").transform(findings)
    if len(counts) < 2:
        return findings.withColumn("score", F.coalesce("label", F.lit(0.0)))
    draw = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "textkey", "start"), F.lit(1_000_000))
    share = F.when(F.col("label") == 1, F.lit(int(1e6 * min(1, sample / counts[1.0])))).otherwise(F.lit(int(1e6 * min(1, sample / counts[0.0]))))
    train = vectors.where("label is not null").where(draw < share).select("_vector", "label")
    forest = RandomForestClassifier(featuresCol="_vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, probabilityCol="_probability").fit(train)
    return forest.transform(vectors).withColumn("score", vector_to_array("_probability")[1]).drop("_vector", "_probability", "rawPrediction", "prediction")


def scan(documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Every finding with its features and score, over the whole table."""
    docs = documents.select("doc_id", "text")
    found = saved(candidates(docs), "candidates")
    return scored(saved(described(found, dictionary(docs)), "findings"), sample)


def scan_table(documents: DataFrame) -> DataFrame:
    """doc_id, start, end, found_sha256, score, kept: one row per finding."""
    out = scan(documents)
    return out.select("doc_id", F.col("start").cast("long").alias("start"), (F.col("start") + F.char_length("found")).cast("long").alias("end"),
                      F.sha2(F.col("found").cast("binary"), 256).alias("found_sha256"), F.round("score", 6).alias("score"), (F.col("score") >= THRESHOLD).alias("kept"))
