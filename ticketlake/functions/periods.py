"""Date windows.  Everything takes ``as_of``; nothing reads the clock."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Look-back of the default window, overlap and fallback of a sync.
DEFAULT_LOOKBACK_DAYS = 2
SYNC_OVERLAP_HOURS = {"user": 1, "company": 2}
SYNC_FALLBACK_DAYS = {"user": 7, "company": 30}
INACTIVE_LOOKBACK_DAYS = 30


def to_day(value: str | date | datetime) -> date:
    """A day from a date or from ``yyyy-M-d`` text (unpadded parts are accepted)."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return datetime.strptime(value, "%Y-%m-%d").date()


def is_valid_date(value: str) -> bool:
    try:
        to_day(value)
    except ValueError:
        return False
    return True


def valid_date(col: Column) -> Column:
    """Row-wise form: a real calendar day written as year-month-day."""
    shape = col.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$") & ~col.startswith("0000")
    return shape & col.try_cast("date").isNotNull()


def default_window(start=None, end=None, *, as_of: date | datetime) -> tuple[date, date]:
    """The given window, or the last three calendar days if either end is missing."""
    if start and end:
        return to_day(start), to_day(end)
    today = to_day(as_of)
    return today - timedelta(days=DEFAULT_LOOKBACK_DAYS), today


def run_window(mode: str, *, as_of: date | datetime, start=None, end=None, days: int = 3):
    """The windows a run mode loads: a list of (start, end) days; backlog is [(None, None)]."""
    today = to_day(as_of)
    if mode == "today":
        return [(today, today)]
    if mode == "yesterday":
        day = today - timedelta(days=1)
        return [(day, day)]
    if mode == "range":
        if not (is_valid_date(str(start)) and is_valid_date(str(end))):
            raise ValueError(f"not a year-month-day date: {start!r} or {end!r}")
        return [(to_day(start), to_day(end))]
    if mode == "daily":
        return [(today - timedelta(days=i),) * 2 for i in range(days, -1, -1)]
    if mode == "backlog":
        return [(None, None)]
    raise ValueError(f"unknown run mode: {mode}")


def closed_window(col: Column, dtype: T.DataType, start, end) -> Column:
    """``start 00:00:00 <= col <= end 23:59:59``; text columns compare as text.

    Literals carry the column's own type, so the scan gets a pushed filter.
    """
    low, high = f"{to_day(start):%Y-%m-%d} 00:00:00", f"{to_day(end):%Y-%m-%d} 23:59:59"
    if isinstance(dtype, T.StringType):
        return col.between(F.lit(low), F.lit(high))
    return col.between(F.lit(low).cast(dtype), F.lit(high).cast(dtype))


def in_window(df: DataFrame, column: str, start, end) -> DataFrame:
    """Rows inside a closed window; an open window (None, None) keeps every row."""
    if start is None and end is None:
        return df
    return df.where(closed_window(F.col(column), df.schema[column].dataType, start, end))


def day_spine(spark: SparkSession, as_of: date | datetime, days: int) -> DataFrame:
    """One row per day, ``as_of - days`` to ``as_of``."""
    today = F.lit(to_day(as_of)).cast("date")
    return spark.range(1).select(
        F.explode(F.sequence(F.date_sub(today, days), today)).alias("day")
    )


def daily_slices(df: DataFrame, column: str, as_of: date | datetime, days: int) -> DataFrame:
    """Rows of the last ``days`` + 1 days, each tagged with the day it belongs to."""
    today = to_day(as_of)
    day = F.to_date(F.substring(F.col(column).cast("string"), 1, 10))
    return in_window(df, column, today - timedelta(days=days), today).withColumn("day", day)
