"""Documents with everything that may go wrong, and small helpers."""

from __future__ import annotations

import duckdb
from pyspark.sql import types as T

from tests.conftest import SF_DIR

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
#: names that the operators use themselves
CLASHING = ["id", "row", "text_key", "digest", "content", "kept", "score", "lines", "spans", "own", "key", "utf8", "k1", "piece", "bucket", "set_key", "_spread"]

PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards quietly judge " * 9
LINES = "\n".join(f"line number {k} of the shared passage with some words" for k in range(30))
LONG = " ".join(f"word{k % 977}" for k in range(30_000))


def rows() -> list[tuple]:
    texts = [
        None,
        "",
        " \t\n ",
        "a",
        "one two three four",
        "one two three four",
        "One  two\nthree four ",
        PASSAGE,
        PASSAGE + " and an own end",
        "An own start. " + PASSAGE,
        "x\n" + LINES + "\ny",
        "z z\n" + LINES,
        LINES + "\nother",
        LONG,
        "aaaa " * 500,
        "b" * 3000,
        "mail me at jane.doe@example.org or +1 (555) 010-9999, card 4111 1111 1111 1111, host 10.0.0.255 10.0.0.256",
        "été über ñandú 日本語 テキスト 😀 " * 40,
        "tabs\tand\r\nreturns\x0b\x0c here",
    ]
    out = [(k, t, "en", f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    out += [(100, "repeated row " * 12, "en", "s", 1)] * 3  # the same row again and again
    out += [(None, "repeated row " * 12, None, None, None), (None, None, None, None, None), (None, "no id " * 90, "en", "s", 2)]
    return out


def awkward(spark, clash: bool = False):
    df = spark.createDataFrame(rows(), SCHEMA)
    return clashing(df) if clash else df


def clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents() -> list[tuple]:
    """The small table's documents as (doc_id, text)."""
    return duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall()


def as_bag(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
