"""Exact deduplication: local groups, salted digest groups, then salt winners, comparing whole contents each time.

Built-in functions only.  Texts are equal when they are identical without
white space (``[\\x20\\x09-\\x0D]``).  The content itself is a grouping key at
every stage, so two texts that merely share a digest never become one group.

1. Local: the partial aggregate of a task keeps one row per content.
2. Salted: those rows meet per (digest, content, salt).  The salt is the task
   that read them, so a content that fills a third of the table arrives at
   ``salts`` tasks with at most one row from each reading task.
3. Global: the at most ``salts`` winners of each content are combined.

Defined results: a null text is an empty text; empty texts are equal to each
other.  The longest original wins, then the smallest id; a null id loses
against any other.  Rows that repeat an id and its text get the same verdict
(``deduplicated`` still returns one of them).  An empty table gives an empty
result.  Other columns are never looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import col, text_of

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalized(text: str = "text") -> Column:
    return F.regexp_replace(text_of(text), WHITE_SPACE, "")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """One row per distinct content: digest, content_key, keep_id, keep_chars, group_size."""
    rows = df.select(
        col(id_col).alias("id"),
        normalized(text_col).alias("content"),
        F.char_length(text_of(text_col)).alias("chars"),
    ).select(
        F.unhex(F.sha2("content", 256)).alias("digest"),
        "content",
        (F.spark_partition_id() % salts).alias("salt"),
        # smallest first: most characters, then a present id, then the smallest id
        F.struct((-F.col("chars")).alias("shortness"), F.col("id").isNull().alias("nameless"), "id").alias("rank"),
    )
    salted = rows.groupBy("digest", "content", "salt").agg(F.min("rank").alias("rank"), F.count("*").alias("size"))
    return (
        salted.groupBy("digest", "content")
        .agg(F.min("rank").alias("rank"), F.sum("size").alias("group_size"))
        .select(
            "digest",
            F.xxhash64("content").alias("content_key"),
            F.col("rank.id").alias("keep_id"),
            (-F.col("rank.shortness")).alias("keep_chars"),
            "group_size",
        )
    )


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    The verdicts come back by a join on digest and a second, independent hash.
    Its rows are narrow; AQE splits the partition of a hot digest.
    """
    groups = exact_groups(df, id_col, text_col, salts)
    rows = df.select(
        col(id_col).alias(id_col),
        normalized(text_col).alias("content"),
        F.char_length(text_of(text_col)).alias("chars"),
    ).select(
        id_col,
        "chars",
        F.unhex(F.sha2("content", 256)).alias("digest"),
        F.xxhash64("content").alias("content_key"),
    )
    return rows.join(groups.hint("merge"), ["digest", "content_key"]).select(
        id_col,
        "keep_id",
        "group_size",
        (F.col("keep_id").eqNullSafe(col(id_col)) & (F.col("chars") == F.col("keep_chars"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """The rows of ``df`` that stay, one for each distinct text, with all their columns."""
    inner = df.select(F.struct("*").alias("row"), col(id_col).alias("id"), text_of(text_col).alias("text"))
    keyed = inner.withColumn("sha", F.sha2(F.regexp_replace("text", WHITE_SPACE, ""), 256))
    wins = exact_dedup(df, id_col, text_col, salts).where("kept").select(
        F.col("text_sha256").alias("win"), col(id_col).alias("win_id")
    )
    kept = keyed.join(
        wins.dropDuplicates(), (F.col("sha") == F.col("win")) & F.col("id").eqNullSafe(F.col("win_id"))
    )
    # rows that repeat the winner's id: the longest, one of them
    one = kept.groupBy("sha").agg(F.max_by("row", F.char_length("text")).alias("row"))
    return one.select("row.*")
