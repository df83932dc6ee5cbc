"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.session import scratch_dir


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage with files that every executor can reach, so a lost
    executor costs only the tasks it was running.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(name: str = "text") -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def col(name: str) -> Column:
    """A top-level column, whatever characters its name holds."""
    return F.col(f"`{name}`")


def spread_join(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join a table that may hold hot keys with an aggregate that has one row per key.

    The aggregate already lies by its key, so Spark would join it in place and
    leave all rows of a hot key to one task.  A second key, a hash of the first,
    asks for a new exchange on both sides, and partitions that come from plain
    exchanges are what AQE splits when they are skewed.
    """
    extra = F.xxhash64(col(on))
    a, b = left.withColumn("_spread", extra), right.withColumn("_spread", extra)
    return a.join(b, [on, "_spread"], how).drop("_spread")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where a public tokenizer's file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)
