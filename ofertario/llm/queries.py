"""The registered queries of this package, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ofertario.llm import (
    exact_dedup,
    jaccard,
    language,
    lexical,
    licenses,
    lm,
    minhash,
    mixing,
    nearest,
    negatives,
    packing,
    pii,
    sharding,
)
from ofertario.llm.common import table

#: Weights of the sources by name, going round.
WEIGHTS = [3, 1, 2]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.scan(docs, pii.train(docs))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents"), words=3, percent=90)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    verdicts = exact_dedup.dedup(docs, exact_dedup.new_index(spark))
    return verdicts.select(
        "doc_id",
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan(table(spark, sf_dir, "documents"), WEIGHTS, share=1.5, max_repeats=2)
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source", "finish")


def op5_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.shard(table(spark, sf_dir, "documents"), 16)
    return shards.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.label(table(spark, sf_dir, "documents"))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    queries = vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"))
    return nearest.neighbours(vectors, queries, k=20)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    apart = language.held_out(F.col("doc_id"), 3, 1)
    model = language.fit(docs.where(~apart))
    return language.predict(docs, model).select(
        "doc_id", apart.alias("held_out"), "lang_pred", "score", "rejected"
    )


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    apart = language.held_out(F.col("doc_id"), 7, 2)
    return lm.train_and_score(docs, apart).withColumn("held_out", apart)


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path, keep_ids=False)


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.link(table(spark, sf_dir, "documents"), words=2, percent=80)


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    anchors = vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("anchor_id"))
    return negatives.mine(vectors.withColumn("label", label), anchors, positives=5, negatives=3, least=50, most=95)


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), k=50)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {n: f for n, f in globals().items() if n.startswith("op") and n[2].isdigit()}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    """SQL only where it gives every column; the others are tested by brute force."""
    return {
        "op7_nearest": """
            WITH usable AS (
                SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
                WHERE embedding IS NOT NULL
                  AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
                  AND len([x FOR x IN embedding IF x <> 0]) > 0),
            pairs AS (
                SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.v, r.v) AS score
                FROM usable q JOIN usable r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v)
                WHERE q.vec_id % 20 = 0)
            SELECT query_id, rank, vec_id, score FROM (
                SELECT *, CAST(row_number() OVER (
                    PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
                FROM pairs)
            WHERE rank <= 20""",
        "op3_exact_dedup": """
            SELECT doc_id,
                   max(doc_id) OVER same AS keep_id,
                   count(*) OVER same AS group_size,
                   doc_id = max(doc_id) OVER same AS kept,
                   sha256(coalesce(text, '')) AS text_sha256
            FROM documents
            WINDOW same AS (PARTITION BY coalesce(text, ''))""",
        "op12_negatives": """
            WITH usable AS (
                SELECT row_number() OVER () AS r, vec_id,
                       CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                       [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
                FROM embeddings
                WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
                  AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
            pairs AS (
                SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                       CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
                FROM usable a JOIN usable b ON a.r <> b.r AND len(a.v) = len(b.v)
                WHERE a.vec_id % 50 = 0),
            positives AS (
                SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score,
                       row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place
                FROM pairs WHERE same QUALIFY place <= 5)
            SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
                   CAST(row_number() OVER (
                       PARTITION BY p.r, place ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM positives p JOIN pairs n USING (r, anchor_id)
            WHERE NOT n.same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
            QUALIFY rank <= 3""",
        "op13_search": r"""
            WITH doc_terms AS (
                SELECT doc, doc_id, unnest(regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM (SELECT row_number() OVER () AS doc, doc_id, text FROM documents)),
            item_terms AS (
                SELECT DISTINCT item_id, unnest(regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM benchmark),
            lengths AS (SELECT doc, count(*) AS n FROM doc_terms GROUP BY doc),
            totals AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS words FROM lengths),
            postings AS (SELECT doc, doc_id, term, count(*) AS tf FROM doc_terms
                         WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL),
            weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(documents) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
                        FROM postings, totals GROUP BY term),
            scores AS (
                SELECT item_id, doc, doc_id, CAST(sum(
                    w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * documents) // words)))) AS BIGINT) AS score
                FROM item_terms JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (doc), totals
                GROUP BY ALL)
            SELECT item_id, CAST(row_number() OVER (
                       PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
            FROM scores WHERE score > 0
            QUALIFY rank <= 50""",
    }
