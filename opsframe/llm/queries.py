"""The registered queries of this folder: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opsframe.llm import decontaminate, extract, fingerprint, langid, minhash, packing, pii, quantize, secrets, shard, simhash, substring, trie
from opsframe.llm.common import table


def op1_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_table(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_digest(table(spark, sf_dir, "pages"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeats_digest(table(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans_table(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_table(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_table(table(spark, sf_dir, "documents"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.shard_digest(table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint of 3-word shingles and its component at 3 or fewer differing bits."""
    return simhash.simhash_components(table(spark, sf_dir, "documents"), k=3, distance=3)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of every usable vector: 16 parts, 64 entries, 2 rounds."""
    return quantize.codes_digest(table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_leaks": op1_leaks,
    "op2_fingerprints": op2_fingerprints,
    "op3_packing": op3_packing,
    "op4_main_text": op4_main_text,
    "op5_repeats": op5_repeats,
    "op6_personal_data": op6_personal_data,
    "op7_secrets": op7_secrets,
    "op8_language": op8_language,
    "op9_shards": op9_shards,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_simhash": op11_simhash,
    "op12_vector_codes": op12_vector_codes,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLE: dict[str, str] = {
    "op12_vector_codes": """
        WITH kept AS (
          SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
          FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS (SELECT vec_id, p, list_slice(v, p * 4 + 1, p * 4 + 4) AS v FROM kept, (SELECT unnest(range(16)) AS p)),
        book0 AS (
          SELECT q.p, f.e, q.v FROM parts q
          JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64) f ON q.vec_id = f.vec_id),
        near0 AS (
          SELECT q.vec_id, q.p, min(list_sum(list_transform(list_zip(q.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 64 + b.e) AS best
          FROM parts q JOIN book0 b ON q.p = b.p GROUP BY q.vec_id, q.p),
        means1 AS (
          SELECT p, e, list(m ORDER BY i) AS v FROM (
            SELECT p, e, i, (s - ((s % c) + c) % c) // c AS m FROM (
              SELECT q.p, n.best % 64 AS e, t.i, sum(q.v[t.i])::BIGINT AS s, count(*) AS c
              FROM parts q JOIN near0 n ON q.vec_id = n.vec_id AND q.p = n.p, (SELECT unnest(range(1, 5)) AS i) t GROUP BY 1, 2, 3))
          GROUP BY p, e),
        book1 AS (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book0 b LEFT JOIN means1 m ON b.p = m.p AND b.e = m.e),
        near1 AS (
          SELECT q.vec_id, q.p, min(list_sum(list_transform(list_zip(q.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 64 + b.e) AS best
          FROM parts q JOIN book1 b ON q.p = b.p GROUP BY q.vec_id, q.p),
        means2 AS (
          SELECT p, e, list(m ORDER BY i) AS v FROM (
            SELECT p, e, i, (s - ((s % c) + c) % c) // c AS m FROM (
              SELECT q.p, n.best % 64 AS e, t.i, sum(q.v[t.i])::BIGINT AS s, count(*) AS c
              FROM parts q JOIN near1 n ON q.vec_id = n.vec_id AND q.p = n.p, (SELECT unnest(range(1, 5)) AS i) t GROUP BY 1, 2, 3))
          GROUP BY p, e),
        book2 AS (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book1 b LEFT JOIN means2 m ON b.p = m.p AND b.e = m.e),
        near2 AS (
          SELECT q.vec_id, q.p, min(list_sum(list_transform(list_zip(q.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 64 + b.e) AS best
          FROM parts q JOIN book2 b ON q.p = b.p GROUP BY q.vec_id, q.p),
        codes AS (
          SELECT k.vec_id, k.label, string_agg(printf('%02x', (n.best % 64)::INT), '' ORDER BY n.p) AS code, sum(n.best // 64)::BIGINT AS error
          FROM kept k JOIN near2 n ON k.vec_id = n.vec_id GROUP BY k.vec_id, k.label),
        digest AS (SELECT sha256(string_agg(list_aggregate(v, 'string_agg', ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2)
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM codes, digest
    """,
    "op13_prefix_trie": """
        WITH own AS (
          SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
          FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        hashed AS (
          SELECT conv_id, turns, xor(4294967295::BIGINT, list_reduce(
            [4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
            lambda s, c: list_reduce([xor(s, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1))))) % 9 AS h
          FROM own),
        built AS (
          SELECT c.conv_id, list_slice(coalesce(b.turns, []), 1, c.h) || list_slice(c.turns, c.h + 1, len(c.turns)) AS path
          FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5),
        members AS (
          SELECT conv_id, d, list_slice(path, 1, d) AS pre, len(path) = d AS ends
          FROM (SELECT conv_id, path, unnest(range(len(path) + 1)) AS d FROM built)),
        nodes AS (
          SELECT d, pre, min(conv_id) AS conv_id, count(*) AS n_convs,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
                 CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * strlen(pre[d].text) END AS saves
          FROM members GROUP BY d, pre),
        children AS (SELECT d - 1 AS d, list_slice(pre, 1, d - 1) AS pre, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
        counted AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.d = c.d AND n.pre = c.pre),
        below AS (
          SELECT up AS d, list_slice(pre, 1, up) AS pre, count(*) FILTER (n_children = 0) AS n_leaves, sum(saves) AS saved_tokens
          FROM (SELECT pre, saves, n_children, unnest(range(d + 1)) AS up FROM counted) GROUP BY 1, 2)
        SELECT c.conv_id, c.d::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, b.n_leaves,
               b.saved_tokens::BIGINT AS saved_tokens, c.ends_sha256
        FROM counted c JOIN below b ON c.d = b.d AND c.pre = b.pre
        LEFT JOIN nodes p ON p.d = c.d - 1 AND p.pre = list_slice(c.pre, 1, c.d - 1)
    """,
}
