"""The registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collectra.llm import ann, bpe, exact_dedup, langid, line_dedup, merkle, mixing, phrases, quality, simhash, token_counts, topk, toxicity
from collectra.llm.common import pick, sha256_text, table, texts
from collectra.llm.merkle_sql import manifest_sql


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(texts(table(spark, sf_dir, "documents")), public_tokenizers.path("byte_bpe_50k.json"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), k=20, every=20)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = line_dedup.dedup_lines(pick(table(spark, sf_dir, "documents"), "doc_id", "text"))
    return d.select("doc_id", "n_lines", "n_equal", "n_near", sha256_text(F.coalesce("text", F.lit(""))).alias("text_sha256"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return d.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.phrases(table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents")).drop("source")


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


QUERIES = {f.__name__: f for f in (op1_quality, op2_mixing, op3_bpe, op4_language, op5_token_counts, op6_toxicity, op7_neighbours, op8_line_dedup,
                                   op9_exact_dedup, op10_simhash, op11_phrases, op12_merkle, op13_topk)}

ORACLE_SQL = {
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op11_phrases": r"""
        WITH words AS (
            SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
            FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                            '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
        grams AS MATERIALIZED (
            SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS g
            FROM words, range(1, 5) AS t(k) WHERE len(w) >= k),
        f AS MATERIALIZED (SELECT lang, g, any_value(k) AS k, count(*) AS a, string_split(any_value(g), ' ') AS w FROM grams GROUP BY lang, g HAVING count(*) >= 30),
        total AS (SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang),
        cuts AS MATERIALIZED (SELECT lang, g, a, j, array_to_string(w[1:j], ' ') AS head, array_to_string(w[j + 1:], ' ') AS tail
                              FROM f, range(1, 4) AS t(j) WHERE j < k),
        best AS (
            SELECT c.lang, c.g, c.a, h.a AS l, r.a AS r, ((2000000 * c.a::HUGEINT) // (h.a + r.a))::BIGINT AS score
            FROM cuts c JOIN f h ON h.lang = c.lang AND h.g = c.head JOIN f r ON r.lang = c.lang AND r.g = c.tail
            QUALIFY row_number() OVER (PARTITION BY c.lang, c.g ORDER BY score, j) = 1),
        inner_ones AS MATERIALIZED (
            SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS g, max(a) AS most
            FROM f, range(2, 4) AS s(m), range(1, 4) AS t(i) WHERE k > m AND i + m - 1 <= k GROUP BY ALL)
        SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.g) AS rank,
               b.g AS phrase, b.a, l, r, n, score
        FROM best b JOIN total USING (lang) LEFT JOIN inner_ones o ON o.lang = b.lang AND o.g = b.g
        WHERE o.most IS NULL OR 100 * o.most::HUGEINT < 80 * b.a::HUGEINT
        QUALIFY rank <= 2000""",
    "op12_merkle": manifest_sql(),
    "op13_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding))
        SELECT q.vec_id AS query_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.e, c.e) DESC, c.vec_id)::INTEGER AS rank,
               c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
        FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0 QUALIFY rank <= 5""",
}
