from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ticketlake.functions import periods as P

AS_OF = datetime(2024, 1, 31, 17, 5)
EDGES = [
    "2024-01-10 00:00:00", "2024-01-12 23:59:59", "2024-01-12 23:59:59.5", "2024-01-13 00:00:00",
    "2024-01-09 23:59:59", None,
]


def test_closed_window_on_text_and_time(spark):
    text = spark.createDataFrame([(v,) for v in EDGES], "t STRING")
    kept = [r["t"] for r in P.in_window(text, "t", "2024-1-10", date(2024, 1, 12)).collect()]
    assert kept == EDGES[:2]
    typed = text.select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert P.in_window(typed, "t", "2024-01-10", "2024-01-12").count() == 2
    assert P.in_window(text, "t", None, None).count() == len(EDGES)


def test_default_window():
    assert P.default_window(as_of=AS_OF) == (date(2024, 1, 29), date(2024, 1, 31))
    assert P.default_window("2024-01-01", None, as_of=AS_OF) == (date(2024, 1, 29), date(2024, 1, 31))
    assert P.default_window("2024-1-1", "2024-01-05", as_of=AS_OF) == (date(2024, 1, 1), date(2024, 1, 5))


def test_run_windows():
    day = date(2024, 1, 31)
    assert P.run_window("today", as_of=AS_OF) == [(day, day)]
    assert P.run_window("yesterday", as_of=AS_OF) == [(date(2024, 1, 30),) * 2]
    assert P.run_window("backlog", as_of=AS_OF) == [(None, None)]
    assert P.run_window("daily", as_of=AS_OF, days=2) == [(date(2024, 1, d),) * 2 for d in (29, 30, 31)]
    assert P.run_window("range", as_of=AS_OF, start="2024-01-05", end="2024-01-09") == [(date(2024, 1, 5), date(2024, 1, 9))]
    with pytest.raises(ValueError):
        P.run_window("range", as_of=AS_OF, start="05/01/2024", end="2024-01-09")
    with pytest.raises(ValueError):
        P.run_window("other", as_of=AS_OF)


@pytest.mark.parametrize("text", ["2025-09-01", "2025-9-1", "2025-02-30", "01/09/2025", "", "2025-13-01", "2025-09-01 10:00:00", "25-09-01"])
def test_valid_date_row_form_agrees_with_the_driver_form(spark, text):
    df = spark.createDataFrame([(text,)], "t STRING")
    assert df.select(F.coalesce(P.valid_date(F.col("t")), F.lit(False))).first()[0] == P.is_valid_date(text)


def test_daily_slices_are_the_window_cut_by_day(spark):
    df = spark.createDataFrame([(v,) for v in EDGES], "t STRING")
    got = {(r["t"], r["day"]) for r in P.daily_slices(df, "t", datetime(2024, 1, 13), 3).collect()}
    # Text just after the second compares above it only on the last day.
    assert got == {(t, date.fromisoformat(t[:10])) for t in EDGES[:4]}
