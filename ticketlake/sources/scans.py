"""Windowed and projected reads of the resources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.functions.columns import is_set, not_empty
from ticketlake.functions.periods import in_window
from ticketlake.operators.normalize import project_schema
from ticketlake.schemas import COMPANY_TYPES, INCIDENT


def incident_scan(records: DataFrame, start, end, keep: list[str] | None = None) -> DataFrame:
    """Incidents opened in the window, on the fixed 42-column text schema.

    ``keep`` names further columns to carry along, such as the page order.
    """
    extra = [records.schema[c] for c in keep or [] if c in records.columns]
    return project_schema(in_window(records, "opened_at", start, end), T.StructType([*INCIDENT.fields, *extra]))


def task_scan(records: DataFrame, start, end) -> DataFrame:
    return in_window(records, "opened_at", start, end).where(not_empty(F.col("parent")))


def sla_scan(records: DataFrame, start, end) -> DataFrame:
    return in_window(records, "sys_created_on", start, end).where(not_empty(F.col("task")))


def time_worked_scan(records: DataFrame, start, end) -> DataFrame:
    return in_window(records, "sys_created_on", start, end).where(not_empty(F.col("task")))


def companies_by_type(company: DataFrame, company_type: str = "customer") -> DataFrame:
    """Active companies of one type."""
    if company_type not in COMPANY_TYPES:
        raise ValueError(f"company type must be one of {COMPANY_TYPES}, not {company_type!r}")
    return company.where(is_set(company, company_type) & is_set(company, "active"))


def warehouse_scan(spark: SparkSession, source: str) -> DataFrame:
    """A stored table by catalog name, or by path when it contains a slash."""
    return spark.read.parquet(source) if "/" in source else spark.table(source)
