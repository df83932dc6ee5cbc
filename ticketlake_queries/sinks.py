"""Sinks: merge, rejects, typed tables, archive slices, retention, CSV."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ticketlake.operators import archive as A
from ticketlake.operators import dedup, merge, normalize, runlog, storage
from ticketlake.session import scratch_dir
from ticketlake.sources.keyed import KeyedTable
from ticketlake.sources.tables import TableStore
from ticketlake_queries.registry import double, query, text
from ticketlake_queries.shapes import EVENTS_AS_OF, ORDERS_AS_OF, Data

TARGET = ["sys_id", "user_name", "name", "email", "department", "active"]

LAST = """
WITH last_change AS (
  SELECT sys_id, name, department FROM (
    SELECT *, row_number() OVER (PARTITION BY sys_id ORDER BY seq DESC) AS rn FROM user_changes) AS t
  WHERE rn = 1 OR sys_id IS NULL
)"""

MERGED = (
    LAST
    + """, merged AS (
  SELECT coalesce(t.sys_id, s.sys_id) AS sys_id, t.user_name,
         CASE WHEN s.hit THEN s.name ELSE t.name END AS name, t.email,
         CASE WHEN s.hit THEN s.department ELSE t.department END AS department, t.active,
         CASE WHEN t.sys_id IS NULL THEN 'insert' WHEN s.hit IS NULL THEN 'keep'
              WHEN s.name IS NOT DISTINCT FROM t.name AND s.department IS NOT DISTINCT FROM t.department THEN 'unchanged'
              ELSE 'update' END AS merge_action
  FROM (SELECT * FROM usr) AS t FULL OUTER JOIN (SELECT *, true AS hit FROM last_change) AS s ON t.sys_id = s.sys_id
)
"""
)


def _stored(d: Data) -> KeyedTable:
    table = KeyedTable(d.spark, scratch_dir(d.spark, "merge"))
    table.replace(d.usr.select(*TARGET))
    return table


@query("merge_upsert", MERGED + "SELECT sys_id, user_name, name, email, department, active FROM merged")
def merge_upsert(d: Data):
    """The stored table after its buckets took the batch."""
    table = _stored(d)
    table.merge(d.user_changes, ["seq"])
    return table.read()


@query("merge_join", MERGED + "SELECT * FROM merged")
def merge_join(d: Data):
    return _stored(d).actions(d.user_changes, ["seq"])


@query(
    "db_metrics",
    MERGED
    + "SELECT count(*) FILTER (merge_action IN ('insert', 'update')) AS records_written, "
    + "count(*) FILTER (merge_action = 'insert') AS inserted, count(*) FILTER (merge_action = 'update') AS updated, "
    + "count(*) FILTER (merge_action = 'unchanged') AS unchanged, count(*) FILTER (merge_action = 'keep') AS untouched FROM merged",
)
def db_metrics(d: Data):
    return merge.merge_metrics(_stored(d).actions(d.user_changes, ["seq"]))


@query("merge_frames", MERGED + "SELECT * FROM merged")
def merge_frames(d: Data):
    """The same upsert of two frames that no table stores."""
    return merge.merge_actions(d.usr.select(*TARGET), d.user_changes, "sys_id", ["seq"])


@query("dedup_last_wins", LAST + "SELECT sys_id, name, department FROM last_change")
def dedup_last_wins(d: Data):
    return dedup.last_wins(d.user_changes, "sys_id", ["seq"]).drop("seq")


@query("create_if_missing", LAST + "SELECT sys_id, name, department FROM last_change")
def create_if_missing(d: Data):
    batch = d.user_changes
    table = merge.create_if_missing(d.spark, batch.drop("seq"))
    return merge.merge_upsert(table, batch, "sys_id", ["seq"])


_REASONS = [
    "CASE WHEN sys_id IS NULL THEN 'sys_id:missing' END",
    "CASE WHEN length(sys_id) > 32 THEN 'sys_id:too long' END",
    "CASE WHEN name IS NULL THEN 'name:missing' END",
    "CASE WHEN length(name) > 255 THEN 'name:too long' END",
    "CASE WHEN customer IS NOT NULL AND lower(customer) NOT IN ('true', 'false', '1', '0') THEN 'customer:bad value' END",
    "CASE WHEN length(phone) > 40 THEN 'phone:too long' END",
    "CASE WHEN active IS NOT NULL AND lower(active) NOT IN ('true', 'false', '1', '0') THEN 'active:bad value' END",
    "CASE WHEN sys_updated_on IS NOT NULL AND TRY_CAST(sys_updated_on AS TIMESTAMP) IS NULL THEN 'sys_updated_on:bad value' END",
]


@query("row_rejects", f"SELECT sys_id, phone, nullif(concat_ws(',', {', '.join(_REASONS)}), '') AS reject_reason FROM company_raw")
def row_rejects(d: Data):
    accepted, rejected = normalize.split_rejects(d.company_raw, "company")
    both = accepted.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(rejected)
    return both.select("sys_id", "phone", "reject_reason")


def _bool_sql(c: str, default: str) -> str:
    return (
        f"coalesce(CASE WHEN lower({c}) IN ('true', '1') THEN true WHEN lower({c}) IN ('false', '0') THEN false END, "
        f"{default}) AS {c}"
    )


@query(
    "typed_conform",
    "SELECT sys_id, name, CAST(NULL AS VARCHAR) AS parent, "
    + ", ".join(_bool_sql(c, "false") for c in ("customer", "vendor", "manufacturer"))
    + ", phone, "
    + _bool_sql("active", "true")
    + ", TRY_CAST(sys_updated_on AS TIMESTAMP) AS sys_updated_on, TIMESTAMP '2001-08-02 00:00:00' AS etl_created_at FROM company_raw",
)
def typed_conform(d: Data):
    out = normalize.typed_conform(d.company_raw, "company", ORDERS_AS_OF)
    return out.select(
        "sys_id", "name", "parent", "customer", "vendor", "manufacturer", "phone", "active", "sys_updated_on",
        "etl_created_at",
    )


ENTRY = ["id", "data_extraction", "extraction_type", "start_date", "end_date", "record_count"]


@query(
    "archive_replace_slice",
    """
    WITH windowed AS (
      SELECT id, data_extraction, extraction_type, start_date, end_date, record_count FROM archive_entry
      WHERE NOT coalesce(extraction_type = 'range' AND start_date = DATE '2024-01-10' AND end_date = DATE '2024-01-10', false)
    ), no_backlog AS (
      SELECT * FROM windowed WHERE extraction_type <> 'backlog'
    ), kept AS (
      SELECT * FROM no_backlog WHERE NOT (extraction_type = 'daily' AND data_extraction = DATE '2024-01-20')
    ), fresh AS (
      SELECT CAST(-1 AS BIGINT) AS id, DATE '2024-01-20' AS data_extraction, extraction_type, CAST(NULL AS DATE) AS start_date,
             CAST(NULL AS DATE) AS end_date, CAST(sum(record_count) AS BIGINT) AS record_count
      FROM archive_entry GROUP BY extraction_type
    )
    SELECT id, CAST(data_extraction AS VARCHAR) AS data_extraction, extraction_type, CAST(start_date AS VARCHAR) AS start_date,
           CAST(record_count AS BIGINT) AS record_count
    FROM (SELECT * FROM kept UNION ALL SELECT * FROM fresh) AS u
    """,
)
def archive_replace_slice(d: Data):
    entries = d.archive_entry.select(*ENTRY).withColumn("record_count", F.col("record_count").cast("long"))
    none = F.lit(None).cast("date")
    saved = d.archive_entry.groupBy("extraction_type").agg(F.sum("record_count").alias("record_count"))
    saved = saved.select(
        F.lit(-1).cast("long").alias("id"), F.lit("2024-01-20").cast("date").alias("data_extraction"),
        "extraction_type", none.alias("start_date"), none.alias("end_date"), "record_count",
    )
    state = entries
    for kind, window in (("range", ("2024-01-10", "2024-01-10")), ("backlog", (None, None)), ("daily", (None, None))):
        new = saved.where(F.col("extraction_type") == kind)
        state = A.replace_slice(state, new, kind, *window, as_of=EVENTS_AS_OF.replace(day=20))
    return text(state, "data_extraction", "start_date").drop("end_date")


@query(
    "run_log_retention",
    "SELECT execution_id, started_at, status FROM run_log WHERE NOT coalesce(started_at < TIMESTAMP '2024-01-16 00:00:00', false)",
)
def run_log_retention(d: Data):
    kept, _ = runlog.retention(d.run_log, EVENTS_AS_OF, days=15)
    return kept.select("execution_id", "started_at", "status")


@query(
    "run_log_cut",
    "SELECT execution_id, started_at, status FROM run_log WHERE NOT coalesce(started_at < TIMESTAMP '2024-01-16 00:00:00', false)",
)
def run_log_cut(d: Data):
    """What the stored log holds after old runs were removed from it."""
    store = TableStore(d.spark, scratch_dir(d.spark, "log"))
    store.append("run_log", d.run_log.select("execution_id", "started_at", "status"), month_of="started_at")
    store.cut("run_log", "started_at", EVENTS_AS_OF - timedelta(days=15))
    return store.read_appended("run_log")


@query(
    "run_log_retention_removed",
    "SELECT count(*) FILTER (started_at < TIMESTAMP '2024-01-16 00:00:00') AS removed_rows FROM run_log",
)
def run_log_retention_removed(d: Data):
    return runlog.retention(d.run_log, EVENTS_AS_OF, days=15)[1]


SIZED = {
    "incident": ["sys_id", "number", "state", "priority", "urgency", "impact", "short_description", "opened_at",
                 "closed_at", "company", "resolved_by", "opened_by", "caller_id"],
    "usr": ["sys_id", "user_name", "name", "email", "company", "department", "active", "first_name", "last_name", "phone",
            "title", "last_login", "sys_created_on", "sys_updated_on", "etl_updated_at"],
    "company": ["sys_id", "name", "customer", "vendor", "manufacturer", "phone", "website", "city", "state",
                "country", "active", "sys_created_on", "sys_updated_on", "etl_updated_at"],
    "task_sla": ["sys_id", "task", "sys_created_on", "stage", "business_percentage"],
    "task_time_worked": ["sys_id", "task", "sys_created_on", "sys_created_by", "time_in_seconds"],
}


def sized_tables(d: Data):
    return {t: getattr(d, t).select(*cols) for t, cols in SIZED.items()}


def _size_row(table: str, cols: list[str]) -> str:
    total = " + ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)), 0)" for c in cols)
    return (
        f"SELECT '{table}' AS table_name, count(*) AS record_count, "
        f"CAST(round(CAST(sum({total}) * 100 AS DECIMAL(24,0)) / 1024) / 100 AS DECIMAL(20,2)) AS size_kb FROM {table}"
    )


SIZES = " UNION ALL ".join(_size_row(t, c) for t, c in SIZED.items())


@query("table_sizes", f"SELECT table_name, record_count, CAST(size_kb AS DOUBLE) AS size_kb FROM ({SIZES}) AS s")
def table_sizes(d: Data):
    return double(storage.table_sizes(sized_tables(d)), "size_kb")


REPORT_ROWS = f"""
SELECT 'normalized' AS model, table_name AS table_type, '2024-01-31' AS date, record_count AS records,
       CAST(size_kb AS DOUBLE) AS size_kb, CAST(NULL AS DOUBLE) AS compressed_size_kb, CAST(NULL AS DOUBLE) AS compression_ratio
FROM ({SIZES}) AS s
UNION ALL
SELECT 'json_compressed', extraction_type, CAST(data_extraction AS VARCHAR), CAST(coalesce(record_count, 0) AS BIGINT),
       CAST(coalesce(json_size_kb, 0) AS DOUBLE), CAST(coalesce(compressed_size_kb, 0) AS DOUBLE),
       CAST(coalesce(compression_ratio, 0) AS DOUBLE)
FROM archive_entry
"""


@query("union_report_rows", REPORT_ROWS)
def union_report_rows(d: Data):
    rows = storage.report_rows(storage.table_sizes(sized_tables(d)), d.archive_entry, EVENTS_AS_OF)
    return double(rows, "size_kb", "compressed_size_kb", "compression_ratio")


@query("csv_export", REPORT_ROWS)
def csv_export(d: Data):
    path = scratch_dir(d.spark, "csv")
    rows = storage.report_rows(storage.table_sizes(sized_tables(d)), d.archive_entry, EVENTS_AS_OF)
    storage.export_csv(rows, path)
    schema = (
        "model STRING, table_type STRING, date STRING, records BIGINT, size_kb DOUBLE, "
        "compressed_size_kb DOUBLE, compression_ratio DOUBLE"
    )
    return d.spark.read.schema(schema).option("header", True).csv(path)
