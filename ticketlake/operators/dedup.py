"""One row per key.  Spark limits each key's rows to one per task before the
shuffle (window group limit), so a key with very many copies stays cheap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row per key, the first in the given order."""
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def keep_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row per key in the given order; NULL is one key."""
    return first_per_key(df, key, [F.asc(c) for c in order])


def last_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row per key in the given order; rows without a key all stay."""
    keyed = first_per_key(df.where(F.col(key).isNotNull()), key, [F.desc(c) for c in order])
    return keyed.unionByName(df.where(F.col(key).isNull()))
