"""Column report of a table: declared type and observed content in one pass."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_profile(df: DataFrame, names: Iterable[str] | None = None, prefix: str | None = None) -> DataFrame:
    """Per column: position, type, rows, NULLs, longest text.

    ``names`` or ``prefix`` (literal) restrict the report.  All columns share one
    aggregate; the single wide row is then turned into one row per column.
    """
    wanted = set(names) if names is not None else None
    picked = [
        (i, f) for i, f in enumerate(df.schema.fields, start=1)
        if (wanted is None or f.name in wanted) and (prefix is None or f.name.startswith(prefix))
    ]
    if not picked:
        schema = (
            "ordinal_position INT, column_name STRING, data_type STRING, "
            "row_count BIGINT, null_count BIGINT, max_length INT"
        )
        return df.sparkSession.createDataFrame([], schema)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, f in picked:
        col = F.col(f"`{f.name}`")
        aggs += [
            F.count_if(col.isNull()).alias(f"nulls_{i}"),
            F.max(F.length(col.cast("string"))).alias(f"longest_{i}"),
        ]
    entries = [
        F.struct(
            F.lit(i).alias("ordinal_position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("n").alias("row_count"),
            F.col(f"nulls_{i}").alias("null_count"),
            F.col(f"longest_{i}").alias("max_length"),
        )
        for i, f in picked
    ]
    return df.agg(*aggs).select(F.inline(F.array(*entries)))
