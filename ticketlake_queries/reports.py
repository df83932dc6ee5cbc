"""Ordering, aggregates and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketlake.operators import apilog, runlog, storage, sync, views
from ticketlake.operators import archive as A
from ticketlake_queries.registry import double, query, text
from ticketlake_queries.shapes import EVENTS_AS_OF, ORDERS_AS_OF, Data
from ticketlake_queries.shaping import PERIOD
from ticketlake_queries.sinks import SIZES, sized_tables


def mean_sql(col: str, cond: str | None = None) -> str:
    value = f"CASE WHEN {cond} THEN {col} END" if cond else col
    return f"CAST(sum({value}) AS DOUBLE) / count({value})"


# The running ratio as a plain fold over all saves in order.
FOLD = """
SELECT list_reduce(list_prepend(CAST(0 AS DOUBLE), list(CAST(compression_ratio AS DOUBLE) ORDER BY created_at, id)),
                   lambda a, r: CASE WHEN a = 0 THEN r ELSE (a + r) / 2 END) AS running_ratio
FROM archive_entry WHERE compression_ratio IS NOT NULL
"""


@query("running_ratio", f"SELECT round(running_ratio, 9) AS running_ratio FROM ({FOLD}) AS f")
def running_ratio(d: Data):
    return A.running_ratio(d.archive_entry).select(F.round("running_ratio", 9).alias("running_ratio"))


@query(
    "recent_runs",
    f"""
    SELECT execution_id, execution_type, {PERIOD} AS period, status, CAST(duration_seconds AS DOUBLE) AS duration_seconds,
           total_records_processed, CASE WHEN json_storage_enabled = 1 THEN 'Sim' ELSE 'Não' END AS json_enabled,
           started_at, error_message
    FROM run_log ORDER BY started_at DESC, execution_id DESC LIMIT 50
    """,
)
def recent_runs(d: Data):
    return double(runlog.recent_runs(d.run_log), "duration_seconds")


@query(
    "recent_runs_n",
    """
    SELECT execution_id, execution_type, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date,
           started_at, CAST(duration_seconds AS DOUBLE) AS duration_seconds, status, total_records_processed,
           json_storage_enabled, error_message
    FROM run_log ORDER BY started_at DESC, execution_id DESC LIMIT 10
    """,
)
def recent_runs_n(d: Data):
    return text(double(runlog.recent_runs_n(d.run_log), "duration_seconds"), "start_date", "end_date")


LISTING = """
SELECT id, CAST(data_extraction AS VARCHAR) AS data_extraction, extraction_type, coalesce(record_count, 0) AS record_count,
       CAST(coalesce(json_size_kb, 0) AS DOUBLE) AS json_size_kb, CAST(coalesce(compressed_size_kb, 0) AS DOUBLE) AS compressed_size_kb,
       CAST(coalesce(compression_ratio, 0) AS DOUBLE) AS compression_ratio, created_at
FROM archive_entry ORDER BY created_at DESC, id DESC
"""
_KB = ["json_size_kb", "compressed_size_kb", "compression_ratio"]


@query("archive_listing", LISTING)
def archive_listing(d: Data):
    return text(double(A.listing(d.archive_entry), *_KB), "data_extraction")


@query("archive_recent5", LISTING + "LIMIT 5")
def archive_recent5(d: Data):
    return text(double(A.recent(d.archive_entry, 5), *_KB), "data_extraction")


@query(
    "run_summary",
    f"""
    SELECT execution_type, count(*) AS total_executions, count(*) FILTER (status = 'success') AS successful_executions,
           count(*) FILTER (status = 'failed') AS failed_executions, {mean_sql('duration_seconds')} AS avg_duration_seconds,
           {mean_sql('total_records_processed')} AS avg_records_processed, max(started_at) AS last_execution,
           {mean_sql('compression_ratio', 'json_storage_enabled = 1')} AS avg_compression_ratio
    FROM run_log GROUP BY execution_type
    """,
)
def run_summary(d: Data):
    return runlog.run_summary(d.run_log)


@query(
    "run_perf_7d",
    f"""
    SELECT execution_type, {mean_sql('duration_seconds')} AS avg_duration, {mean_sql('total_api_requests')} AS avg_requests
    FROM run_log WHERE started_at >= TIMESTAMP '2024-01-24 00:00:00' GROUP BY execution_type
    """,
)
def run_perf_7d(d: Data):
    return runlog.run_perf(d.run_log, EVENTS_AS_OF, 7)


@query("incidents_by_company", "SELECT company, count(*) AS incident_count FROM incident GROUP BY company")
def incidents_by_company(d: Data):
    return views.incidents_by_company(d.incident)


@query("incident_count", "SELECT count(*) AS incident_count FROM incident")
def incident_count(d: Data):
    return views.incident_count(d.incident)


@query(
    "last_sync",
    """
    SELECT 'user' AS entity, coalesce(max(etl_updated_at) - INTERVAL 1 HOUR, TIMESTAMP '2001-07-26 00:00:00') AS last_sync FROM usr
    UNION ALL
    SELECT 'company', coalesce(max(etl_updated_at) - INTERVAL 2 HOUR, TIMESTAMP '2001-07-03 00:00:00') FROM company
    """,
)
def last_sync(d: Data):
    rows = [
        sync.last_sync(df, entity, ORDERS_AS_OF).select(F.lit(entity).alias("entity"), "last_sync")
        for entity, df in (("user", d.usr), ("company", d.company))
    ]
    return rows[0].unionByName(rows[1])


@query(
    "archive_by_date",
    f"""
    SELECT CAST(data_extraction AS VARCHAR) AS data_extraction, CAST(sum(record_count) AS BIGINT) AS total_records,
           CAST(sum(json_size_kb) AS DOUBLE) AS total_json_kb,
           CAST(sum(coalesce(compressed_size_kb, json_size_kb)) AS DOUBLE) AS total_effective_kb,
           {mean_sql('compression_ratio')} AS avg_compression_ratio
    FROM archive_entry GROUP BY data_extraction ORDER BY data_extraction DESC
    """,
)
def archive_by_date(d: Data):
    return text(double(A.by_date(d.archive_entry), "total_json_kb", "total_effective_kb"), "data_extraction")


@query(
    "archive_by_type",
    f"""
    SELECT extraction_type, count(*) AS extractions_count, {mean_sql('json_size_kb')} AS avg_json_size_kb,
           {mean_sql('compressed_size_kb')} AS avg_compressed_size_kb, {mean_sql('compression_ratio')} AS avg_compression_ratio,
           {mean_sql('record_count')} AS avg_records_per_extraction
    FROM archive_entry GROUP BY extraction_type
    """,
)
def archive_by_type(d: Data):
    return A.by_type(d.archive_entry)


TOTALS = f"""
SELECT CAST(coalesce(sum(record_count), 0) AS BIGINT) AS total_records, coalesce(sum(json_size_kb), 0) AS total_json_size_kb,
       coalesce(sum(compressed_size_kb), 0) AS total_compressed_size_kb,
       coalesce({mean_sql('compression_ratio', 'compression_ratio > 0')}, 0) AS average_compression_ratio
FROM archive_entry
"""


@query(
    "archive_totals",
    f"SELECT total_records, CAST(total_json_size_kb AS DOUBLE) AS total_json_size_kb, "
    f"CAST(total_compressed_size_kb AS DOUBLE) AS total_compressed_size_kb, average_compression_ratio FROM ({TOTALS}) AS t",
)
def archive_totals(d: Data):
    return double(A.totals(d.archive_entry), "total_json_size_kb", "total_compressed_size_kb")


def round_sql(x: str, places: int = 2) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {places}) AS DOUBLE)"


EFFICIENCY = f"""
WITH n AS (SELECT CAST(sum(record_count) AS BIGINT) AS t_rows, CAST(sum(size_kb) AS DOUBLE) AS t_kb FROM ({SIZES}) AS s),
j AS (SELECT total_records AS j_rows, CAST(total_json_size_kb AS DOUBLE) AS j_kb, CAST(total_compressed_size_kb AS DOUBLE) AS c_kb,
             average_compression_ratio AS ratio FROM ({TOTALS}) AS t),
e AS (
  SELECT t_rows AS normalized_records, t_kb AS normalized_size_kb, {round_sql('t_kb * 1024 / t_rows')} AS normalized_bytes_per_record,
         j_rows AS json_records, j_kb AS json_size_kb, c_kb AS compressed_size_kb, {round_sql('ratio')} AS avg_compression_ratio,
         {round_sql('j_kb * 1024 / j_rows')} AS json_bytes_per_record, {round_sql('c_kb * 1024 / j_rows')} AS compressed_bytes_per_record,
         (t_kb - c_kb) * 100 / t_kb AS saved, {round_sql('(t_kb - c_kb) * 100 / t_kb')} AS space_saved_percent,
         {round_sql('c_kb / t_kb', 3)} AS json_vs_normalized_ratio
  FROM n, j)
"""
_REPORT = [
    "normalized_size_kb", "normalized_bytes_per_record", "json_size_kb", "compressed_size_kb", "avg_compression_ratio",
    "json_bytes_per_record", "compressed_bytes_per_record", "space_saved_percent", "json_vs_normalized_ratio",
]
_REPORT_COLUMNS = "normalized_records, json_records, " + ", ".join(_REPORT)


@query("storage_efficiency", EFFICIENCY + f"SELECT {_REPORT_COLUMNS} FROM e")
def storage_efficiency(d: Data):
    report = storage.efficiency(storage.table_sizes(sized_tables(d)), d.archive_entry)
    return double(report, *_REPORT).drop("saved_exact", "comparable")


RECOMMEND = (
    "CASE "
    + " ".join(f"WHEN saved > {b} THEN '{c}'" for b, c in ((50, "archive"), (20, "historic"), (0, "trade-off"), (-20, "similar")))
    + " WHEN saved IS NULL THEN 'insufficient' ELSE 'tables' END"
)


@query(
    "storage_recommendation",
    f"""
    WITH parts AS (
      SELECT extraction_type, CAST(sum(json_size_kb) AS DOUBLE) AS t_kb, CAST(sum(compressed_size_kb) AS DOUBLE) AS c_kb
      FROM archive_entry GROUP BY extraction_type, data_extraction
    ), gains AS (SELECT CASE WHEN t_kb > 0 AND c_kb > 0 THEN (t_kb - c_kb) * 100 / t_kb END AS saved FROM parts)
    SELECT {RECOMMEND} AS recommendation_code, count(*) AS slices FROM gains GROUP BY 1
    """,
)
def storage_recommendation(d: Data):
    """The verdict for every slice of the archive: raw against compressed size."""
    parts = d.archive_entry.groupBy("extraction_type", "data_extraction").agg(
        F.sum("json_size_kb").alias("t_kb"), F.sum("compressed_size_kb").alias("c_kb")
    )
    gains = parts.select(
        F.when((F.col("t_kb") > 0) & (F.col("c_kb") > 0), (F.col("t_kb") - F.col("c_kb")) * 100 / F.col("t_kb")).alias(
            "saved_exact"
        )
    )
    return storage.recommend(gains).groupBy("recommendation_code").agg(F.count(F.lit(1)).alias("slices"))


PROJECTION = """
CASE WHEN space_saved_percent > 0 THEN normalized_size_kb * space_saved_percent / 100 / 1024 * 12 END AS annual_savings_mb,
CASE WHEN space_saved_percent > 0 THEN normalized_size_kb * space_saved_percent / 100 / 1024 * 12 * 5 END AS five_year_savings_mb,
CASE WHEN space_saved_percent > 0 THEN normalized_size_kb * space_saved_percent / 100 / 1024 * 12 * 5 / 1024 END AS five_year_savings_gb
"""


@query("storage_projection", EFFICIENCY + f"SELECT normalized_size_kb, space_saved_percent, {PROJECTION} FROM e")
def storage_projection(d: Data):
    report = storage.efficiency(storage.table_sizes(sized_tables(d)), d.archive_entry)
    out = storage.project(report).select(
        "normalized_size_kb", "space_saved_percent", "annual_savings_mb", "five_year_savings_mb", "five_year_savings_gb"
    )
    return double(out, "normalized_size_kb", "space_saved_percent")


@query("storage_report", EFFICIENCY + f"SELECT {_REPORT_COLUMNS}, {RECOMMEND} AS recommendation_code, {PROJECTION} FROM e")
def storage_report(d: Data):
    report = storage.storage_report(sized_tables(d), d.archive_entry)
    return double(report, *_REPORT).drop("saved_exact", "comparable", "recommendation")


API = """
SELECT {key} count(*) AS total_requests, count(*) FILTER (failed = 1) AS failed_requests,
       CAST(sum(CAST(elapsed_seconds AS DECIMAL(20,6))) AS DOUBLE) AS total_api_time,
       round(CAST(sum(CAST(elapsed_seconds AS DECIMAL(20,6))) AS DOUBLE) / greatest(count(*), 1), 5) AS avg_time_per_request,
       round((count(*) - count(*) FILTER (failed = 1)) / greatest(count(*), 1) * 100.0, 5) AS success_rate {more}
FROM request_log {group}
"""


@query("api_metrics", API.format(key="extractor,", more="", group="GROUP BY extractor"))
def api_metrics(d: Data):
    out = double(apilog.api_metrics(d.request_log), "total_api_time", "avg_time_per_request")
    return out.withColumns({c: F.round(c, 5) for c in ("avg_time_per_request", "success_rate")})


@query(
    "api_metrics_total",
    API.format(
        key="",
        more=", round(CAST(sum(CAST(elapsed_seconds AS DECIMAL(20,6))) AS DOUBLE) * 100 / 3600, 5) AS api_share_percent, "
        "round(count(*) / 3600.0, 5) AS requests_per_second",
        group="",
    ),
)
def api_metrics_total(d: Data):
    derived = ["avg_time_per_request", "api_share_percent", "requests_per_second"]
    out = double(apilog.api_totals(d.request_log, 3600), "total_api_time", *derived)
    return out.withColumns({c: F.round(c, 5) for c in (*derived, "success_rate")})


COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS record_count FROM {t}"
    for t in ("incident", "incident_task", "task_sla", "task_time_worked")
)


def _batch(d: Data):
    return {
        "incident": d.incident, "incident_task": d.incident_task,
        "task_sla": d.task_sla, "task_time_worked": d.task_time_worked,
    }


@query("records_by_table", COUNTS)
def records_by_table(d: Data):
    return A.table_counts(_batch(d))


@query(
    "batch_metadata",
    f"SELECT count(*) AS table_count, CAST(sum(record_count) AS BIGINT) AS total_records, "
    f"concat('{{', string_agg(concat('\"', table_name, '\":', CAST(record_count AS VARCHAR)), ',' ORDER BY table_name), '}}') "
    f"AS records_by_table FROM ({COUNTS}) AS c WHERE record_count > 0",
)
def batch_metadata(d: Data):
    return A.batch_metadata(_batch(d))


@query(
    "archive_sizes",
    """
    SELECT conv_id, CAST(round(CAST(sum(strlen(text)) AS DECIMAL(20,6)) / 1024, 2) AS DOUBLE) AS json_size_kb,
           CAST(round(CAST(sum(length(text) - length(replace(text, ' ', ''))) AS DECIMAL(20,6)) / 1024, 2) AS DOUBLE) AS compressed_size_kb,
           CAST(nullif(round(CAST(sum(strlen(text)) - sum(length(text) - length(replace(text, ' ', ''))) AS DECIMAL(20,6)) * 100
                / sum(strlen(text)), 2), 0) AS DOUBLE) AS compression_ratio
    FROM conversations GROUP BY conv_id HAVING sum(strlen(text)) > 0
    """,
)
def archive_sizes(d: Data):
    """Entry sizes and ratios of whole conversations; the number of their spaces stands for the compressed bytes."""
    raw = d.table("conversations").groupBy("conv_id").agg(
        F.sum(F.octet_length("text")).alias("raw"), F.sum(F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))).alias("packed")
    )
    sizes = A.entry_sizes(F.col("raw"), F.col("packed"))
    out = raw.where("raw > 0").select("conv_id", *[c.alias(n) for n, c in sizes.items()])
    return double(out, "json_size_kb", "compressed_size_kb", "compression_ratio")


@query(
    "archive_metrics",
    f"""
    WITH s AS (SELECT count(*) AS total_saves, CAST(coalesce(sum(record_count), 0) AS BIGINT) AS total_records,
      CAST(coalesce(sum(json_size_kb), 0) AS DOUBLE) AS total_json_size_kb,
      CAST(coalesce(sum(compressed_size_kb), 0) AS DOUBLE) AS total_compressed_size_kb FROM archive_entry)
    SELECT *, round(total_json_size_kb / total_saves, 5) AS avg_json_size_kb,
           round(total_compressed_size_kb / total_saves, 5) AS avg_compressed_size_kb,
           (SELECT round(running_ratio, 9) FROM ({FOLD} AND coalesce(compressed_size_kb, 0) <> 0) AS f) AS avg_compression_ratio FROM s
    """,
)
def archive_metrics(d: Data):
    means = ["avg_json_size_kb", "avg_compressed_size_kb"]
    out = double(A.save_metrics(d.archive_entry), "total_json_size_kb", "total_compressed_size_kb", *means)
    return out.withColumns({**{c: F.round(c, 5) for c in means}, "avg_compression_ratio": F.round("avg_compression_ratio", 9)})


@query(
    "run_duration",
    "SELECT execution_id, CAST(round(CAST(date_diff('microsecond', started_at, TIMESTAMP '2024-01-31 00:00:00') AS DECIMAL(30,6)) / 1000000, 2) "
    "AS DOUBLE) AS duration_seconds FROM run_log",
)
def run_duration(d: Data):
    ended = F.lit(EVENTS_AS_OF).cast("timestamp_ntz")
    out = d.run_log.select("execution_id", runlog.run_duration(F.col("started_at"), ended).alias("duration_seconds"))
    return double(out, "duration_seconds")
