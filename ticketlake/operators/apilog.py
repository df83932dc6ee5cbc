"""Request metrics from a request log (extractor, page, elapsed_seconds, failed)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.functions import columns as C


def _seconds():
    # Exact decimals: the sum does not depend on the order of the rows.
    return F.sum(F.col("elapsed_seconds").cast("decimal(20,6)"))


def api_metrics(log: DataFrame) -> DataFrame:
    """Per extractor: requests, failures, time, time per request, success rate."""
    sums = log.groupBy("extractor").agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(F.col("failed").cast("int") == 1).alias("failed_requests"),
        _seconds().alias("total_api_time"),
    )
    return sums.select(
        "*",
        (F.col("total_api_time") / F.greatest("total_requests", F.lit(1))).alias("avg_time_per_request"),
        C.success_rate(F.col("total_requests"), F.col("failed_requests")).alias("success_rate"),
    )


def api_totals(log: DataFrame, run_seconds: float) -> DataFrame:
    """Over all extractors, with the API's share of the run and requests per second."""
    sums = log.agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(F.col("failed").cast("int") == 1).alias("failed_requests"),
        F.coalesce(_seconds(), F.lit(0)).alias("total_api_time"),
    )
    n, run = F.col("total_requests"), F.lit(run_seconds).cast("decimal(20,6)")
    return sums.select(
        "*",
        F.when(n > 0, (n - F.col("failed_requests")) / n * 100).otherwise(F.lit(0.0)).alias("success_rate"),
        C.safe_ratio(F.col("total_api_time"), n).alias("avg_time_per_request"),
        C.safe_ratio(F.col("total_api_time") * 100, run).alias("api_share_percent"),
        C.safe_ratio(n.cast("decimal(20,0)"), run).alias("requests_per_second"),
    )
