from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tests.conftest import rows
from ticketlake.functions import columns as C
from ticketlake.operators import apilog, runlog

AS_OF = datetime(2024, 1, 31, 12)


def test_period_labels(spark):
    d, e = date(2024, 1, 2), date(2024, 1, 3)
    df = spark.createDataFrame([(d, d), (d, e), (d, None), (None, e), (None, None)], "s DATE, e DATE")
    got = [r[0] for r in df.select(C.period_label(F.col("s"), F.col("e"))).collect()]
    assert got == ["2024-01-02", "2024-01-02 até 2024-01-03", "N/A", "N/A", "N/A"]


def test_short_text_cuts_after_fifty(spark):
    df = spark.createDataFrame([("x" * 50,), ("x" * 51,), (None,)], "t STRING")
    assert [r[0] for r in df.select(C.short_text(F.col("t"))).collect()] == ["x" * 50, "x" * 50 + "...", None]


def test_retention_boundary(spark):
    cutoff = AS_OF - timedelta(days=90)
    df = spark.createDataFrame([(1, cutoff), (2, cutoff - timedelta(seconds=1)), (3, None)], "n INT, started_at TIMESTAMP_NTZ")
    kept, removed = runlog.retention(df, AS_OF)
    assert [r[0] for r in rows(kept.select("n"))] == [1, 3]
    assert removed.first()[0] == 1


def test_durations_round_to_cents(spark):
    df = spark.createDataFrame([(AS_OF, AS_OF + timedelta(seconds=9, milliseconds=665)), (AS_OF, None)], "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ")
    got = [r[0] for r in df.select(runlog.run_duration(F.col("a"), F.col("b"))).collect()]
    assert float(got[0]) == 9.67 and got[1] is None


def test_report_line(spark):
    df = spark.createDataFrame(
        [("12345678-rest", "daily", None, None, AS_OF, 1.5, "odd", 1234567, True, None)],
        "execution_id STRING, execution_type STRING, start_date DATE, end_date DATE, started_at TIMESTAMP_NTZ, "
        "duration_seconds DOUBLE, status STRING, total_records_processed INT, json_storage_enabled BOOLEAN, error_message STRING",
    )
    assert tuple(runlog.recent_run_report(df).first()) == (
        "❓", "DAILY", "", " 📦", "12345678...", "31/01/2024 12:00", 1.5, "1,234,567", "Status: odd",
    )


def test_request_metrics_without_requests(spark):
    log = spark.createDataFrame([], "extractor STRING, page LONG, elapsed_seconds DOUBLE, failed INT")
    got = apilog.api_totals(log, 0).first()
    assert got["total_requests"] == 0 and got["success_rate"] == 0
    assert float(got["avg_time_per_request"]) == 0 and float(got["requests_per_second"]) == 0
