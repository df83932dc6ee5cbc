"""From raw documents to packed sequences: what is kept, shortened or dropped on the way.

Every stage takes the documents its predecessor left.  Toxic documents go,
repeated chunks of lines are cut out, of near-duplicates one document stays,
contaminated documents go, and the rest is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.llm import decontaminate, line_dedup, near_dedup, packing, toxicity
from ticketlake.llm.common import settle, table, tokenizer_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = line_dedup.shortened(docs)
    return left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.representatives(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("packing", packing_stage),
]

#: no SQL for trained models, MinHash and packing: tests compare each stage with a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
