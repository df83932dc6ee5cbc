"""Run audit log and its reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.functions import columns as C

# Status marks of the run report.
STATUS_MARKS = {"success": "✅", "failed": "❌", "partial": "⚠️", "running": "🔄"}
UNKNOWN_MARK = "❓"
JSON_MARK = " 📦"
RETENTION_DAYS = 90


def run_duration(started: Column, ended: Column) -> Column:
    """Seconds between two timestamps, 2 places."""
    micros = F.timestamp_diff("MICROSECOND", started, ended)
    return C.fixed(micros.cast("decimal(20,0)") / 1_000_000)


def run_summary(log: DataFrame) -> DataFrame:
    return log.groupBy("execution_type").agg(
        F.count(F.lit(1)).alias("total_executions"),
        F.count_if(F.col("status") == "success").alias("successful_executions"),
        F.count_if(F.col("status") == "failed").alias("failed_executions"),
        C.mean(F.col("duration_seconds")).alias("avg_duration_seconds"),
        C.mean(F.col("total_records_processed")).alias("avg_records_processed"),
        F.max("started_at").alias("last_execution"),
        C.mean(F.when(F.col("json_storage_enabled").cast("int") == 1, F.col("compression_ratio"))).alias(
            "avg_compression_ratio"
        ),
    )


def run_perf(log: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    since = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL '{days}' DAY")
    return (
        log.where(F.col("started_at") >= since)
        .groupBy("execution_type")
        .agg(C.mean(F.col("duration_seconds")).alias("avg_duration"), C.mean(F.col("total_api_requests")).alias("avg_requests"))
    )


def newest(log: DataFrame, n: int) -> DataFrame:
    """Newest runs first; the id breaks ties."""
    return log.orderBy(F.desc("started_at"), F.desc("execution_id")).limit(n)


def recent_runs(log: DataFrame, n: int = 50) -> DataFrame:
    return newest(log, n).select(
        "execution_id", "execution_type",
        C.period_label(F.col("start_date"), F.col("end_date")).alias("period"),
        "status", "duration_seconds", "total_records_processed",
        C.yes_no(F.col("json_storage_enabled")).alias("json_enabled"),
        "started_at", "error_message",
    )


def recent_runs_n(log: DataFrame, n: int = 10) -> DataFrame:
    return newest(log, n).select(
        "execution_id", "execution_type", "start_date", "end_date", "started_at", "duration_seconds", "status",
        "total_records_processed", "json_storage_enabled", "error_message",
    )


def recent_run_report(log: DataFrame, n: int = 5) -> DataFrame:
    """The newest runs as display text."""
    marks = F.create_map(*[F.lit(x) for pair in STATUS_MARKS.items() for x in pair])
    label = C.period_label(F.col("start_date"), F.col("end_date"))
    return newest(log, n).select(
        F.coalesce(F.try_element_at(marks, F.col("status")), F.lit(UNKNOWN_MARK)).alias("mark"),
        F.upper("execution_type").alias("execution_type"),
        F.when(label == "N/A", "").otherwise(F.concat(F.lit(" ("), label, F.lit(")"))).alias("period"),
        F.when(F.col("json_storage_enabled").cast("int") == 1, JSON_MARK).otherwise("").alias("json_mark"),
        F.concat(F.substring("execution_id", 1, 8), F.lit("...")).alias("short_id"),
        F.date_format("started_at", "dd/MM/yyyy HH:mm").alias("started"),
        "duration_seconds",
        F.format_number(F.coalesce("total_records_processed", F.lit(0)), 0).alias("records"),
        F.when(C.not_empty(F.col("error_message")), F.concat(F.lit("Erro: "), C.short_text(F.col("error_message"))))
        .otherwise(F.concat(F.lit("Status: "), F.col("status")))
        .alias("detail"),
    )


def failed_today(log: DataFrame, as_of: datetime) -> DataFrame:
    today = F.lit(as_of.replace(hour=0, minute=0, second=0, microsecond=0)).cast("timestamp_ntz")
    return log.where((F.col("status") == "failed") & (F.col("started_at") >= today))


def is_expired(as_of: datetime, days: int = RETENTION_DAYS) -> Column:
    cutoff = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL '{days}' DAY")
    return F.coalesce(F.col("started_at") < cutoff, F.lit(False))


def retention(log: DataFrame, as_of: datetime, days: int = RETENTION_DAYS) -> tuple[DataFrame, DataFrame]:
    """(runs to keep, one row with the number removed); a run exactly at the cutoff stays."""
    expired = is_expired(as_of, days)
    return log.where(~expired), log.agg(F.count_if(expired).alias("removed_rows"))
