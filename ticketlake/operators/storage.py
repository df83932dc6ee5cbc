"""Storage comparison of the tables with the compressed archive."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.functions import columns as C
from ticketlake.functions.periods import to_day
from ticketlake.operators import archive as A

# Lower bounds of the saving in per cent, their code and text.
RECOMMENDATIONS = [
    (50, "archive", "JSON comprimido é MUITO mais eficiente - Recomendado para arquivamento"),
    (20, "historic", "JSON comprimido oferece boa economia - Considerar para dados históricos"),
    (0, "trade-off", "JSON comprimido oferece pequena economia - Avaliar trade-offs"),
    (-20, "similar", "Tamanhos similares - Considerar outras vantagens (flexibilidade)"),
]
OTHERWISE = ("tables", "Modelo normalizado é mais eficiente - Manter estrutura atual")
INSUFFICIENT = ("insufficient", "Dados insuficientes para comparação")


def table_sizes(tables: dict[str, DataFrame | None]) -> DataFrame:
    """Rows and KB of all values per table; a table that is not there counts 0."""
    out = None
    for name, df in tables.items():
        if df is None:
            spark = next(t for t in tables.values() if t is not None).sparkSession
            row = spark.range(1).select(
                F.lit(0).cast("long").alias("record_count"), F.lit(0).cast("decimal(38,2)").alias("size_kb")
            )
        else:
            total = F.coalesce(F.sum(C.value_bytes(df.columns)), F.lit(0)).cast("decimal(30,0)")
            row = df.agg(
                F.count(F.lit(1)).alias("record_count"),
                C.fixed(total / 1024).cast("decimal(38,2)").alias("size_kb"),
            )
        row = row.select(F.lit(name).alias("table_name"), "record_count", "size_kb")
        out = row if out is None else out.unionByName(row)
    return out


def efficiency(sizes: DataFrame, entries: DataFrame) -> DataFrame:
    """One row: totals and bytes per record of both models, saving and ratio.

    Two small aggregates are stacked and folded, so there is no join.
    """
    amount = "decimal(38,6)"
    none = F.lit(0).cast(amount)
    tables = sizes.select(
        F.col("record_count").alias("t_rows"), F.col("size_kb").cast(amount).alias("t_kb"),
        F.lit(0).cast("long").alias("j_rows"), none.alias("j_kb"), none.alias("c_kb"), none.alias("ratio"),
    )
    archive = A.totals(entries).select(
        F.lit(0).cast("long").alias("t_rows"), none.alias("t_kb"),
        F.col("total_records").cast("long").alias("j_rows"),
        F.col("total_json_size_kb").cast(amount).alias("j_kb"),
        F.col("total_compressed_size_kb").cast(amount).alias("c_kb"),
        F.col("average_compression_ratio").cast(amount).alias("ratio"),
    )
    both = tables.unionByName(archive).agg(
        *[F.sum(c).alias(c) for c in ("t_rows", "t_kb", "j_rows", "j_kb", "c_kb", "ratio")]
    )
    # Two places of precision more than shown; sizes are far below 10^17 KB.
    d = lambda c: F.col(c).cast("decimal(20,2)")
    per_record = lambda kb, rows: F.when(
        F.col(rows) > 0, C.fixed(d(kb) * 1024 / F.col(rows).cast("decimal(15,0)"))
    ).otherwise(F.lit(0))
    comparable = (F.col("t_kb") > 0) & (F.col("c_kb") > 0)
    saved = (d("t_kb") - d("c_kb")) * 100 / d("t_kb")
    return both.select(
        F.col("t_rows").alias("normalized_records"),
        C.fixed(F.col("t_kb")).alias("normalized_size_kb"),
        per_record("t_kb", "t_rows").alias("normalized_bytes_per_record"),
        F.col("j_rows").alias("json_records"),
        C.fixed(F.col("j_kb")).alias("json_size_kb"),
        C.fixed(F.col("c_kb")).alias("compressed_size_kb"),
        C.fixed(F.col("ratio")).alias("avg_compression_ratio"),
        per_record("j_kb", "j_rows").alias("json_bytes_per_record"),
        per_record("c_kb", "j_rows").alias("compressed_bytes_per_record"),
        comparable.alias("comparable"),
        F.when(comparable, saved).alias("saved_exact"),
        F.when(comparable, C.fixed(saved)).otherwise(F.lit(0)).alias("space_saved_percent"),
        F.when(comparable, C.fixed(d("c_kb") / d("t_kb"), 3)).otherwise(F.lit(0)).alias("json_vs_normalized_ratio"),
    )


def recommend(report: DataFrame) -> DataFrame:
    """Adds the recommendation code and text for the exact saving."""
    saved = F.col("saved_exact")
    code = F.when(saved.isNull(), INSUFFICIENT[0])
    text = F.when(saved.isNull(), INSUFFICIENT[1])
    for bound, c, t in RECOMMENDATIONS:
        code, text = code.when(saved > bound, c), text.when(saved > bound, t)
    return report.withColumns({
        "recommendation_code": code.otherwise(OTHERWISE[0]),
        "recommendation": text.otherwise(OTHERWISE[1]),
    })


def project(report: DataFrame) -> DataFrame:
    """Adds yearly and five-year savings (monthly growth), only if there is a saving."""
    # Plain text is enough to see the saving: the rounded per cent is what is projected.
    yearly = F.col("normalized_size_kb").cast("double") * F.col("space_saved_percent").cast("double") / 100 / 1024 * 12
    worth = F.col("space_saved_percent") > 0
    return report.withColumns({
        "annual_savings_mb": F.when(worth, yearly),
        "five_year_savings_mb": F.when(worth, yearly * 5),
        "five_year_savings_gb": F.when(worth, yearly * 5 / 1024),
    })


def storage_report(tables: dict[str, DataFrame | None], entries: DataFrame) -> DataFrame:
    return project(recommend(efficiency(table_sizes(tables), entries)))


def report_rows(sizes: DataFrame, entries: DataFrame, as_of: date | datetime) -> DataFrame:
    """Tables and archive entries in one seven-column layout."""
    tables = sizes.select(
        F.lit("normalized").alias("model"),
        F.col("table_name").alias("table_type"),
        F.lit(to_day(as_of).isoformat()).alias("date"),
        F.col("record_count").alias("records"),
        "size_kb",
    )
    archive = A.listing(entries, ordered=False).select(
        F.lit("json_compressed").alias("model"),
        F.col("extraction_type").alias("table_type"),
        F.col("data_extraction").cast("string").alias("date"),
        F.col("record_count").cast("long").alias("records"),
        F.col("json_size_kb").cast("decimal(38,2)").alias("size_kb"),
        F.col("compressed_size_kb").cast("decimal(38,2)").alias("compressed_size_kb"),
        F.col("compression_ratio").cast("decimal(38,2)").alias("compression_ratio"),
    )
    return tables.unionByName(archive, allowMissingColumns=True)


def export_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)
