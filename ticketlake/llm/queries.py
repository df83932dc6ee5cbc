"""Registered queries of the corpus operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ticketlake.llm import (
    chat,
    decontaminate,
    exact_dedup,
    hard_negatives,
    line_dedup,
    lm_score,
    near_dedup,
    packing,
    pii,
    resampling,
    suffix_dedup,
    toxicity,
    warc,
)
from ticketlake.llm.common import table, tokenizer_path
from ticketlake.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query(
    "op1_exact_dedup",
    r"""
    WITH t AS (
      SELECT doc_id, coalesce(text, '') AS original,
             regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
      FROM documents),
    g AS (
      SELECT *, count(*) OVER (PARTITION BY content) AS group_size,
             first_value(doc_id) OVER (PARTITION BY content ORDER BY length(original) DESC, doc_id) AS keep_id
      FROM t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM g
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query("op7_best_fit_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op2_decontaminate")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slop=2)
    return decontaminate.verdicts(found)


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_near_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents")).drop("text_key", "group_key")


@query(
    "op8_warc",
    """
    WITH p AS (
      SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes,
             sha256(coalesce(html, '')) AS payload_digest FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_id FROM p)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to
    FROM f
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    warc.write_pages(table(spark, sf_dir, "pages"), folder)
    return warc.read_pages(spark, folder).drop("payload")


@query("op3_personal_data")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.personal_data(table(spark, sf_dir, "documents")))


@query("op5_line_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(
        F.col("id").alias("doc_id"),
        "n_lines",
        "n_removed",
        "n_chunks",
        F.sha2(F.coalesce("row.text", F.lit("")), 256).alias("kept_sha256"),
    )


@query("op9_lm_score")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(table(spark, sf_dir, "documents"))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)


@query("op4_suffix_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query(
    "op11_hard_negatives",
    """
    WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
             CAST(list_dot_product(a.q, r.q) AS BIGINT) AS score
      FROM v AS a JOIN v AS r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
    p AS (
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS place FROM s WHERE same)
      WHERE place <= 5),
    n AS (
      SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id, p.score AS positive_score,
             s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id) AS place
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
       AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
    SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
    FROM n WHERE place <= 5
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    shifted = F.when(F.col("vec_id") % 7 == 0, ((F.col("label") + 1) % 10).cast("int")).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", shifted), F.col("vec_id") % 100 == 0)


@query(
    "op12_chat_format",
    r"""
    WITH t AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
      UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    c AS (
      SELECT *, len(regexp_extract_all(text, '<\\*/turn>')) + len(regexp_extract_all(text, '#\\*## ')) AS marks FROM t)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(length(role) + length(text) + marks + 14) AS BIGINT) AS formatted_chars
    FROM c GROUP BY conv_id
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.sql(r"""SELECT -7L AS conv_id, turn, role, r'\### Assistant: </turn> ok' AS text
                        FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(turn, role)""")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    done = chat.format_conversations(rows)
    told = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    back = chat.read_back(done.withColumn("size", F.length("formatted")), keep=("size",))
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", told), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.col("size").cast("long").alias("formatted_chars"),
    )


@query("op13_resampling")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = resampling.importance_resampling(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return scores.select("doc_id", "n_features", "weight", "score", "rank")
