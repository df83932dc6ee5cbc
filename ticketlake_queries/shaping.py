"""Projections, normalisation and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketlake.functions import columns as C
from ticketlake.functions import periods as P
from ticketlake.operators import archive as A
from ticketlake.operators import normalize, runlog, sync, views
from ticketlake.schemas import COMPANY
from ticketlake_queries.registry import double, hash_sql, query
from ticketlake_queries.shapes import EVENTS_AS_OF, ORDERS_AS_OF, Data

_COMPANY_HAS = ["sys_id", "name", "customer", "vendor", "manufacturer", "phone", "website", "city", "state",
                "country", "active", "sys_created_on", "sys_updated_on"]


@query(
    "project_schema",
    "SELECT "
    + ", ".join(
        f"CAST({c} AS VARCHAR) AS {c}" if c in _COMPANY_HAS else f"CAST(NULL AS VARCHAR) AS {c}"
        for c in COMPANY.fieldNames()
    )
    + " FROM company",
)
def project_schema(d: Data):
    return normalize.project_schema(d.company, COMPANY)


@query(
    "normalize_flags",
    "SELECT sys_id, "
    + ", ".join(
        f"CASE WHEN {c} IN ('true', '1') THEN 1 ELSE 0 END AS {c}"
        for c in ("customer", "vendor", "manufacturer", "active")
    )
    + " FROM company_raw",
)
def normalize_flags(d: Data):
    return normalize.normalize_flags(d.company_raw).select("sys_id", "customer", "vendor", "manufacturer", "active")


@query(
    "audit_stamp",
    "SELECT sys_id, parent, TIMESTAMP '2001-08-02 00:00:00' AS etl_created_at, "
    "TIMESTAMP '2001-08-02 00:00:00' AS etl_updated_at FROM incident_task",
)
def audit_stamp(d: Data):
    return normalize.audit_stamp(d.incident_task.select("sys_id", "parent"), ORDERS_AS_OF)


_HASHED = ["sys_id", "user_name", "name", "email", "company", "department", "active", "first_name", "last_name",
           "phone", "title"]


@query("row_hash", f"SELECT sys_id, {hash_sql(_HASHED)} AS etl_hash FROM usr")
def row_hash(d: Data):
    columns = [*_HASHED, "sys_created_on", "sys_updated_on", "etl_updated_at"]
    return normalize.add_row_hash(d.usr.select(*columns)).select("sys_id", "etl_hash")


@query("drop_derived", "SELECT sys_id, company, opened_by FROM incident")
def drop_derived(d: Data):
    empty = F.lit("")
    wide = d.incident.select("sys_id", "company", "opened_by").withColumns({"dv_company": empty, "dv_opened_by": empty})
    return normalize.drop_derived(wide)


@query(
    "ensure_columns",
    "SELECT sys_id, parent, CAST(NULL AS VARCHAR) AS company, CAST(NULL AS VARCHAR) AS resolved_by, "
    "CAST(NULL AS VARCHAR) AS opened_by, CAST(NULL AS VARCHAR) AS caller_id FROM incident_task",
)
def ensure_columns(d: Data):
    return normalize.ensure_columns(d.incident_task.select("sys_id", "parent"))


PERIOD = (
    "CASE WHEN start_date = end_date THEN strftime(start_date, '%Y-%m-%d') "
    "WHEN start_date IS NOT NULL AND end_date IS NOT NULL "
    "THEN concat(strftime(start_date, '%Y-%m-%d'), ' até ', strftime(end_date, '%Y-%m-%d')) ELSE 'N/A' END"
)


@query("period_label", f"SELECT execution_id, {PERIOD} AS period FROM run_log")
def period_label(d: Data):
    return d.run_log.select("execution_id", C.period_label(F.col("start_date"), F.col("end_date")).alias("period"))


@query("json_flag_label", "SELECT execution_id, CASE WHEN json_storage_enabled = 1 THEN 'Sim' ELSE 'Não' END AS json_enabled FROM run_log")
def json_flag_label(d: Data):
    return d.run_log.select("execution_id", C.yes_no(F.col("json_storage_enabled")).alias("json_enabled"))


@query(
    "effective_size",
    "SELECT id, CAST(coalesce(compressed_size_kb, json_size_kb) AS DOUBLE) AS effective_size_kb, "
    "date_diff('day', CAST(created_at AS DATE), DATE '2024-01-31') AS days_old FROM archive_entry",
)
def effective_size(d: Data):
    out = A.summary(d.archive_entry, EVENTS_AS_OF).select("id", "effective_size_kb", F.col("days_old").cast("long"))
    return double(out, "effective_size_kb")


@query(
    "recent_run_report",
    f"""
    SELECT CASE status WHEN 'success' THEN '✅' WHEN 'failed' THEN '❌' WHEN 'partial' THEN '⚠️' WHEN 'running' THEN '🔄' ELSE '❓' END AS mark,
           upper(execution_type) AS execution_type,
           CASE WHEN {PERIOD} = 'N/A' THEN '' ELSE concat(' (', {PERIOD}, ')') END AS period,
           CASE WHEN json_storage_enabled = 1 THEN ' 📦' ELSE '' END AS json_mark,
           concat(substr(execution_id, 1, 8), '...') AS short_id,
           strftime(started_at, '%d/%m/%Y %H:%M') AS started,
           CAST(duration_seconds AS DOUBLE) AS duration_seconds,
           format('{{:,}}', coalesce(total_records_processed, 0)) AS records,
           CASE WHEN coalesce(error_message, '') <> '' THEN concat('Erro: ', CASE WHEN length(error_message) > 50
                THEN concat(substr(error_message, 1, 50), '...') ELSE error_message END)
                ELSE concat('Status: ', status) END AS detail
    FROM run_log ORDER BY started_at DESC, execution_id DESC LIMIT 5
    """,
)
def recent_run_report(d: Data):
    return double(runlog.recent_run_report(d.run_log, 5), "duration_seconds")


# -- predicates ---------------------------------------------------------------


@query(
    "closed_window",
    "SELECT sys_id, opened_at FROM incident WHERE opened_at >= '1997-05-28 00:00:00' AND opened_at <= '1999-12-31 23:59:59'",
)
def closed_window(d: Data):
    return P.in_window(d.incident, "opened_at", "1997-05-28", "1999-12-31").select("sys_id", "opened_at")


@query(
    "default_window",
    "SELECT sys_id, sys_created_on FROM task_time_worked WHERE sys_created_on >= TIMESTAMP '2024-01-28 00:00:00' "
    "AND sys_created_on <= TIMESTAMP '2024-01-30 23:59:59'",
)
def default_window(d: Data):
    window = P.default_window("2024-01-01", None, as_of=EVENTS_AS_OF.replace(day=30))
    return P.in_window(d.task_time_worked, "sys_created_on", *window).select("sys_id", "sys_created_on")


@query(
    "run_window",
    """
    SELECT CAST(CAST(sys_created_on AS DATE) AS VARCHAR) AS day, count(*) AS records,
           CAST(sum(time_in_seconds) AS BIGINT) AS seconds
    FROM task_time_worked
    WHERE sys_created_on >= TIMESTAMP '2024-01-02 00:00:00' AND sys_created_on <= TIMESTAMP '2024-01-31 23:59:59'
    GROUP BY CAST(sys_created_on AS DATE)
    UNION ALL
    SELECT '2024-01-31', 0, 0 WHERE NOT EXISTS (SELECT 1 FROM events WHERE ts >= TIMESTAMP '2024-01-31 00:00:00')
    """,
)
def run_window(d: Data):
    rows = P.daily_slices(d.task_time_worked, "sys_created_on", EVENTS_AS_OF, 29)
    per_day = rows.groupBy("day").agg(
        F.count(F.lit(1)).alias("records"), F.sum("time_in_seconds").alias("seconds")
    )
    spine = P.day_spine(d.spark, EVENTS_AS_OF, 29)
    return spine.join(per_day, "day", "left").select(
        F.col("day").cast("string"), F.coalesce("records", F.lit(0)).alias("records"),
        F.coalesce("seconds", F.lit(0)).alias("seconds"),
    )


@query(
    "valid_date",
    """
    SELECT l_orderkey, l_linenumber, shown, coalesce(TRY_CAST(shown AS DATE) IS NOT NULL, false) AS is_valid FROM (
      SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d')
        WHEN 2 THEN concat(CAST(year(l_shipdate) AS VARCHAR), '-', CAST(month(l_shipdate) AS VARCHAR), '-', CAST(day(l_shipdate) AS VARCHAR))
        WHEN 3 THEN concat(CAST(year(l_shipdate) AS VARCHAR), '-02-30') WHEN 4 THEN strftime(l_shipdate, '%d/%m/%Y')
        WHEN 5 THEN '' ELSE concat(CAST(year(l_shipdate) AS VARCHAR), '-13-01') END AS shown FROM lineitem) AS t
    """,
)
def valid_date(d: Data):
    ship, n = F.col("l_shipdate"), F.col("l_linenumber")
    shown = (
        F.when(n == 1, F.date_format(ship, "yyyy-MM-dd"))
        .when(n == 2, F.concat_ws("-", F.year(ship), F.month(ship), F.day(ship)))
        .when(n == 3, F.concat(F.year(ship), F.lit("-02-30")))
        .when(n == 4, F.date_format(ship, "dd/MM/yyyy"))
        .when(n == 5, "")
        .otherwise(F.concat(F.year(ship), F.lit("-13-01")))
    )
    rows = d.table("lineitem").select("l_orderkey", "l_linenumber", shown.alias("shown"))
    return rows.withColumn("is_valid", P.valid_date(F.col("shown")))


@query("not_empty", "SELECT sys_id, parent FROM incident_task WHERE parent IS NOT NULL AND parent <> ''")
def not_empty(d: Data):
    return d.incident_task.where(C.not_empty(F.col("parent"))).select("sys_id", "parent")


@query(
    "active_or_recent",
    "SELECT sys_id, active, sys_updated_on, CASE WHEN active = 1 THEN 1 ELSE 2 END AS branch FROM usr "
    "WHERE active = 1 OR sys_updated_on >= TIMESTAMP '2001-07-03 00:00:00'",
)
def active_or_recent(d: Data):
    return sync.active_or_recent(d.usr.select("sys_id", "active", "sys_updated_on"), ORDERS_AS_OF)


@query("changed_since", "SELECT sys_id, sys_updated_on FROM usr WHERE sys_updated_on >= TIMESTAMP '2001-07-15 00:00:00'")
def changed_since(d: Data):
    return sync.changed_since(d.usr.select("sys_id", "sys_updated_on"), ORDERS_AS_OF.replace(month=7, day=15))


@query(
    "is_null_checks",
    "SELECT count(*) FILTER (company IS NULL) AS without_company, count(*) FILTER (resolved_by IS NOT NULL) AS with_resolver, "
    "count(*) FILTER (closed_at IS NULL) AS still_open FROM incident",
)
def is_null_checks(d: Data):
    return d.incident.agg(
        F.count_if(F.col("company").isNull()).alias("without_company"),
        F.count_if(F.col("resolved_by").isNotNull()).alias("with_resolver"),
        F.count_if(F.col("closed_at").isNull()).alias("still_open"),
    )


# What the summary shows of an incident, and whose names it shows.
SHOWN = "sys_id, number, short_description, state, priority, urgency, impact, opened_at, closed_at"
NAMED = {"company_name": ("company", "company"), "resolved_by_name": ("usr", "resolved_by"),
         "opened_by_name": ("usr", "opened_by"), "caller_name": ("usr", "caller_id")}

SUMMARY = f"SELECT {SHOWN}, " + ", ".join(
    f"(SELECT max(name) FROM {table} WHERE {table}.sys_id = incident.{key}) AS {shown}" for shown, (table, key) in NAMED.items()
) + " FROM incident "


@query("state_filter", SUMMARY + "WHERE state = '6'")
def state_filter(d: Data):
    return views.in_state(views.incident_summary(d.incident, d.company, d.usr), "6")


@query("company_resolved_filter", "SELECT sys_id, company, resolved_by FROM incident WHERE company = '5' AND resolved_by IS NOT NULL")
def company_resolved_filter(d: Data):
    return views.resolved_for_company(d.incident, "5").select("sys_id", "company", "resolved_by")


@query(
    "failed_today",
    "SELECT execution_id, started_at, error_message FROM run_log WHERE status = 'failed' AND started_at >= TIMESTAMP '2024-01-30 00:00:00'",
)
def failed_today(d: Data):
    as_of = EVENTS_AS_OF.replace(day=30, hour=17)
    return runlog.failed_today(d.run_log, as_of).select("execution_id", "started_at", "error_message")


@query(
    "positive_only",
    "SELECT extraction_type, CAST(sum(CASE WHEN compression_ratio > 0 THEN compression_ratio END) AS DOUBLE) / "
    "count(CASE WHEN compression_ratio > 0 THEN 1 END) AS mean_ratio FROM archive_entry GROUP BY extraction_type",
)
def positive_only(d: Data):
    return d.archive_entry.groupBy("extraction_type").agg(
        C.mean_positive(F.col("compression_ratio")).alias("mean_ratio")
    )
