"""Query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ticketlake_queries.shapes import Data, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(data)`` under a name, with the SQL it must agree with."""

    def register(fn: Callable[[Data], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Data(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return register


def double(df: DataFrame, *names: str) -> DataFrame:
    """Show decimals as doubles."""
    return df.withColumns({n: df[n].cast("double") for n in names})


def text(df: DataFrame, *names: str) -> DataFrame:
    """Show dates as text."""
    return df.withColumns({n: df[n].cast("string") for n in names})


def hash_sql(columns: list[str]) -> str:
    """The change hash in SQL."""
    parts = [
        f"concat('{c}=', coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-'))"
        for c in sorted(columns)
    ]
    return f"md5(concat_ws(';', {', '.join(parts)}))"
