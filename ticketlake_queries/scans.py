"""Sources: pages, windowed scans, reference scans, stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.operators import archive as A
from ticketlake.operators import dedup, runlog, sync
from ticketlake.operators.normalize import flatten_refs
from ticketlake.operators.profile import column_profile
from ticketlake.schemas import INCIDENT_FIELDS, PAGE_LIMIT
from ticketlake.session import scratch_dir
from ticketlake.sources import archive_files, pages, scans
from ticketlake_queries.registry import hash_sql, query, text
from ticketlake_queries.shapes import EVENTS_AS_OF, ORDERS_AS_OF, Data

RAW_FIELDS = ["sys_id", "number", "state", "priority", "urgency", "impact", "short_description", "opened_at", "closed_at",
              "company", "resolved_by", "opened_by", "caller_id"]


def raw_incidents(d: Data) -> DataFrame:
    """Incidents as the source sends them: JSON text, the company as an object or empty text."""
    company = F.expr(
        "parse_json(if(company IS NULL, '\"\"',"
        " to_json(named_struct('link', concat('https://host/company/', company), 'value', company))))"
    )
    columns = [F.col(c) for c in RAW_FIELDS if c != "company"]
    return d.incident.select(
        (F.floor(F.col("sys_id").cast("long") / PAGE_LIMIT) * PAGE_LIMIT).cast("long").alias("offset"),
        F.to_json(F.struct(*columns, company.alias("company"))).alias("record"),
    )


def page_texts(d: Data) -> DataFrame:
    """Pages as text, each with a null and an empty record; plus pages without a result."""
    texts = raw_incidents(d).groupBy("offset").agg(
        F.concat(F.lit('{"result":[null,{},'), F.array_join(F.collect_list("record"), ","), F.lit("]}")).alias("page")
    )
    bare = d.user_group.select(F.lit(-1).cast("long").alias("offset"), F.lit('{"status":"none"}').alias("page"))
    return texts.unionByName(bare)


RAW_SQL = """
SELECT sys_id, number, state, priority, urgency, impact, short_description, opened_at, closed_at,
       coalesce(company, '') AS company, resolved_by, opened_by, caller_id FROM incident
"""


@query("paged_scan", RAW_SQL)
def paged_scan(d: Data):
    path = scratch_dir(d.spark, "pages")
    pages.land_pages(raw_incidents(d), path)
    return flatten_refs(pages.paged_scan(d.spark, path), RAW_FIELDS).select(*RAW_FIELDS)


@query("union_pages", "SELECT count(*) AS records, count(DISTINCT sys_id) AS ids FROM incident")
def union_pages(d: Data):
    path = scratch_dir(d.spark, "pages")
    pages.land_pages(raw_incidents(d), path)
    records = flatten_refs(pages.paged_scan(d.spark, path), ["sys_id"])
    return records.agg(F.count(F.lit(1)).alias("records"), F.countDistinct("sys_id").alias("ids"))


@query("single_page_scan", "SELECT sys_id, name, vendor, type, duration FROM contract_sla")
def single_page_scan(d: Data):
    path = scratch_dir(d.spark, "contracts")
    fields = ["sys_id", "name", "vendor", "type", "duration"]
    records = d.contract_sla.select(
        (F.floor(F.col("part_number") / PAGE_LIMIT) * PAGE_LIMIT).cast("long").alias("offset"),
        F.to_json(F.struct(*fields)).alias("record"),
    )
    pages.land_pages(records, path)
    return flatten_refs(pages.single_page_scan(d.spark, path), fields).select(*fields)


@query("envelope_parse", RAW_SQL)
def envelope_parse(d: Data):
    records = pages.parse_envelope(page_texts(d))
    return flatten_refs(records, RAW_FIELDS).select(*RAW_FIELDS)


@query(
    "flatten_refs",
    """
    SELECT sys_id, coalesce(company, '') AS company, CASE WHEN company IS NOT NULL THEN '' END AS dv_company, resolved_by
    FROM incident
    """,
)
def flatten(d: Data):
    out = flatten_refs(raw_incidents(d).select("record"))  # fields are discovered
    return out.select("sys_id", "company", "dv_company", "resolved_by")


_HAS = ["sys_id", "number", "state", "closed_at", "priority", "urgency", "impact", "company", "caller_id",
        "resolved_by", "opened_by", "short_description", "opened_at"]
INCIDENT_SELECT = ", ".join(c if c in _HAS else f"CAST(NULL AS VARCHAR) AS {c}" for c in INCIDENT_FIELDS)


@query(
    "incident_scan",
    f"SELECT {INCIDENT_SELECT} FROM incident "
    "WHERE opened_at >= '1996-03-01 00:00:00' AND opened_at <= '2000-10-31 23:59:59'",
)
def incident_scan(d: Data):
    return scans.incident_scan(d.incident, "1996-03-01", "2000-10-31")


@query(
    "task_scan",
    "SELECT sys_id, parent, opened_at, state FROM incident_task "
    "WHERE opened_at >= '1996-03-01 00:00:00' AND opened_at <= '2000-10-31 23:59:59' AND parent <> ''",
)
def task_scan(d: Data):
    return scans.task_scan(d.incident_task, "1996-03-01", "2000-10-31").select("sys_id", "parent", "opened_at", "state")


@query(
    "sla_scan",
    "SELECT sys_id, task, sys_created_on, stage, business_percentage FROM task_sla "
    "WHERE sys_created_on >= TIMESTAMP '1996-03-01 00:00:00' AND sys_created_on <= TIMESTAMP '2000-10-31 23:59:59' "
    "AND task IS NOT NULL AND task <> ''",
)
def sla_scan(d: Data):
    return scans.sla_scan(d.task_sla, "1996-03-01", "2000-10-31")


@query(
    "time_worked_scan",
    "SELECT sys_id, task, sys_created_on, sys_created_by, time_in_seconds FROM task_time_worked "
    "WHERE sys_created_on >= TIMESTAMP '2024-01-05 00:00:00' AND sys_created_on <= TIMESTAMP '2024-01-25 23:59:59' "
    "AND task IS NOT NULL AND task <> ''",
)
def time_worked_scan(d: Data):
    return scans.time_worked_scan(d.task_time_worked, "2024-01-05", "2024-01-25")


FEED_BRANCHES = """
WITH branched AS (
  SELECT *, CASE WHEN active = 'true' THEN 1 ELSE 2 END AS branch FROM user_feed
  WHERE active = 'true' OR (active <> 'true' AND sys_updated_on >= TIMESTAMP '2001-07-03 00:00:00')
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY sys_id ORDER BY branch, seq) AS rn FROM branched
)
"""


@query(
    "reference_full_scan",
    FEED_BRANCHES
    + "SELECT sys_id, name, department, active, TIMESTAMP '2001-08-02 00:00:00' AS etl_updated_at, "
    + hash_sql(["sys_id", "name", "department", "active"])
    + " AS etl_hash FROM ranked WHERE rn = 1",
)
def reference_full_scan(d: Data):
    out = sync.reference_full_scan(d.user_feed, "user", ORDERS_AS_OF, ["seq"])
    return out.select("sys_id", "name", "department", "active", "etl_updated_at", "etl_hash")


@query("union_all_branches", FEED_BRANCHES + "SELECT sys_id, name, branch, seq FROM branched")
def union_all_branches(d: Data):
    return sync.active_or_recent(d.user_feed, ORDERS_AS_OF).select("sys_id", "name", "branch", "seq")


@query("dedup_keep_first", "SELECT sys_id, parent, opened_at, seq1, seq2, seq3 FROM (SELECT *, row_number() OVER "
       "(PARTITION BY sys_id ORDER BY seq1, seq2, seq3) AS rn FROM incident_task) AS t WHERE rn = 1")
def dedup_keep_first(d: Data):
    out = dedup.keep_first(d.incident_task, "sys_id", ["seq1", "seq2", "seq3"])
    return out.select("sys_id", "parent", "opened_at", "seq1", "seq2", "seq3")


@query("reference_by_ids", "SELECT sys_id, user_name, email FROM usr WHERE sys_id IN "
       "(SELECT resolved_by FROM incident WHERE resolved_by IS NOT NULL)")
def reference_by_ids(d: Data):
    ids = d.incident.where("resolved_by IS NOT NULL").select("resolved_by").distinct()
    return sync.reference_by_ids(d.usr, ids).select("sys_id", "user_name", "email")


@query("ids_semi", "SELECT sys_id, name, city FROM company WHERE sys_id IN (SELECT company FROM usr)")
def ids_semi(d: Data):
    ids = d.usr.select("company").distinct()
    return sync.reference_by_ids(d.company, ids).select("sys_id", "name", "city")


@query("companies_by_type", "SELECT sys_id, name, customer, vendor, manufacturer FROM company WHERE customer = 1 AND active = 1")
def companies_by_type(d: Data):
    return scans.companies_by_type(d.company, "customer").select("sys_id", "name", "customer", "vendor", "manufacturer")


@query("warehouse_scan", "SELECT * FROM orders")
def warehouse_scan(d: Data):
    return scans.warehouse_scan(d.spark, d.path("orders"))


ARCHIVED = """
SELECT 'incident' AS table_name, sys_id, state, opened_at FROM incident
UNION ALL SELECT 'incident_task', sys_id, state, opened_at FROM incident_task
UNION ALL SELECT 'task_sla', sys_id, NULL, NULL FROM task_sla
UNION ALL SELECT 'task_time_worked', sys_id, NULL, NULL FROM task_time_worked
"""


def archived_tables(d: Data) -> dict[str, DataFrame]:
    """All four tables of an extraction."""
    tables = {n: getattr(d, n) for n in ("incident", "incident_task", "task_sla", "task_time_worked")}
    return {n: df.drop("seq1", "seq2", "seq3") for n, df in tables.items()}


@query("archive_load", ARCHIVED)
def archive_load(d: Data):
    root = scratch_dir(d.spark, "archive")
    entry = archive_files.save_entry(d.spark, archived_tables(d), root, "daily", as_of=EVENTS_AS_OF)
    records = archive_files.load_latest(d.spark, entry, root, EVENTS_AS_OF, "daily")
    fields = F.from_json("record", "sys_id STRING, state STRING, opened_at STRING")
    return records.select(F.col("table").alias("table_name"), fields.alias("r")).select("table_name", "r.*")


@query("run_log_scan", "SELECT execution_id, execution_type, started_at, status FROM run_log "
       "ORDER BY started_at DESC, execution_id DESC LIMIT 10")
def run_log_scan(d: Data):
    return runlog.newest(d.run_log, 10).select("execution_id", "execution_type", "started_at", "status")


_PROFILED = ["sys_id", "number", "state", "priority", "urgency", "impact", "short_description", "opened_at",
             "closed_at", "company", "resolved_by", "opened_by", "caller_id"]


ISO = (
    "strftime(sys_created_on, '%Y-%m-%dT%H:%M:%S') || "
    "CASE WHEN strftime(sys_created_on, '%f') = '000000' THEN '' ELSE strftime(sys_created_on, '.%f') END"
)


@query(
    "column_profile",
    " UNION ALL ".join(
        f"SELECT {i} AS ordinal_position, '{c}' AS column_name, 'string' AS data_type, count(*) AS row_count, "
        f"count(*) - count({c}) AS null_count, max(length({c})) AS max_length FROM incident"
        for i, c in enumerate(_PROFILED, start=1)
    ),
)
def profile(d: Data):
    return column_profile(d.incident)


@query(
    "archive_write",
    "WITH sizes AS ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS record_count, "
        f"sum(strlen(CAST(json_merge_patch('{{}}', json_object({', '.join(f'{chr(39)}{c}{chr(39)}, {e}' for c, e in cols.items())})) AS VARCHAR))) AS json_bytes "
        f"FROM {t}"
        for t, cols in {
            "incident": {c: c for c in _PROFILED},
            "incident_task": {c: c for c in ("sys_id", "parent", "opened_at", "state")},
            "task_sla": {"sys_id": "sys_id", "task": "task", "sys_created_on": ISO, "stage": "stage", "business_percentage": "business_percentage"},
            "task_time_worked": {
                "sys_id": "sys_id", "task": "task", "sys_created_on": ISO, "sys_created_by": "sys_created_by",
                "time_in_seconds": "time_in_seconds",
            },
        }.items()
    )
    + ") SELECT table_name, record_count, CAST(json_bytes AS BIGINT) AS json_bytes, true AS is_smaller FROM sizes",
)
def archive_write(d: Data):
    path = scratch_dir(d.spark, "archive")
    tables = archived_tables(d)
    sizes = archive_files.write_files(d.spark, tables, path)
    return sizes.select(
        F.col("table").alias("table_name"), "record_count", "json_bytes",
        (F.col("compressed_bytes") < F.col("json_bytes")).alias("is_smaller"),
    )


@query(
    "drop_nulls_json",
    "SELECT sys_id, CAST(json_merge_patch('{}', json_object('sys_id', sys_id, 'closed_at', closed_at, 'company', company, "
    "'resolved_by', resolved_by)) AS VARCHAR) AS record FROM incident",
)
def drop_nulls_json(d: Data):
    rows = d.incident.select("sys_id", "closed_at", "company", "resolved_by")
    return A.record_json(rows).select(F.get_json_object("record", "$.sys_id").alias("sys_id"), "record")


@query(
    "archive_latest",
    "SELECT id, CAST(data_extraction AS VARCHAR) AS data_extraction, extraction_type, record_count, created_at FROM "
    "(SELECT *, row_number() OVER (PARTITION BY data_extraction, extraction_type ORDER BY created_at DESC, id DESC) AS rn "
    "FROM archive_entry) AS t WHERE rn = 1",
)
def archive_latest(d: Data):
    out = A.latest_entries(d.archive_entry).select("id", "data_extraction", "extraction_type", "record_count", "created_at")
    return text(out, "data_extraction")
