"""Whole runs, incremental sync in batch and as a stream, and the run log."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.operators import sync
from ticketlake.operators.normalize import add_row_hash, audit_stamp
from ticketlake.plans import audit, loads
from ticketlake.session import scratch_dir
from ticketlake.sources import pages
from ticketlake.sources.tables import TableStore
from ticketlake.streaming.incremental import incremental_stream
from ticketlake_queries.registry import double, hash_sql, query
from ticketlake_queries.scans import RAW_FIELDS, raw_incidents
from ticketlake_queries.shapes import ORDERS_AS_OF, Data

TRACKED = ["sys_id", "name", "department", "active"]


def stored_users(d: Data) -> DataFrame:
    """The first copy of every user, loaded a month ago; one department is not there yet."""
    first = d.user_feed.where("seq = 1 AND department <> 'MACHINERY'").drop("seq")
    return add_row_hash(audit_stamp(first, ORDERS_AS_OF - timedelta(days=31)))


SYNCED = f"""
WITH stored AS (
  SELECT *, TIMESTAMP '2001-07-02 00:00:00' AS etl_updated_at FROM user_feed WHERE seq = 1 AND department <> 'MACHINERY'
), recent AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY sys_id ORDER BY sys_updated_on DESC, seq DESC) AS rn
    FROM user_feed WHERE sys_updated_on >= TIMESTAMP '2001-07-01 23:00:00') AS r WHERE rn = 1
), changes AS (
  SELECT r.*, s.sys_id IS NULL AS is_new FROM recent AS r LEFT JOIN stored AS s ON r.sys_id = s.sys_id
  WHERE s.sys_id IS NULL OR {hash_sql(TRACKED).replace('(sys_id', '(r.sys_id').replace('(name', '(r.name').replace('(department', '(r.department').replace('(active', '(r.active').replace('CAST(sys_id', 'CAST(r.sys_id')}
    <> {hash_sql(TRACKED).replace('(sys_id', '(s.sys_id').replace('(name', '(s.name').replace('(department', '(s.department').replace('(active', '(s.active')}
), state AS (
  SELECT sys_id, name, department, active, sys_updated_on, TIMESTAMP '2001-08-02 00:00:00' AS etl_updated_at FROM changes
  UNION ALL
  SELECT sys_id, name, department, active, sys_updated_on, etl_updated_at FROM stored
  WHERE sys_id NOT IN (SELECT sys_id FROM changes)
)
"""


@query("incremental_sync", SYNCED + f"SELECT *, {hash_sql(TRACKED)} AS etl_hash FROM state")
def incremental_sync(d: Data):
    state, _ = sync.incremental_sync(d.user_feed, stored_users(d), "user", ORDERS_AS_OF, ["seq"])
    return state.drop("etl_created_at")


STREAMED = f"""
    WITH base AS (
      SELECT sys_id, name, department, sys_created_on AS sys_updated_on FROM usr
    ), edits AS (
      SELECT sys_id, name, department, sys_updated_on FROM (
        SELECT CAST(o_custkey AS STRING) AS sys_id, concat('edit ', CAST(o_orderkey AS STRING)) AS name,
               o_orderpriority AS department, o_orderdate AS sys_updated_on,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders) AS o WHERE rn = 1
    ), newer AS (
      SELECT e.* FROM edits AS e LEFT JOIN base AS b ON e.sys_id = b.sys_id
      WHERE b.sys_id IS NULL OR e.sys_updated_on >= b.sys_updated_on
    ), state AS (
      SELECT * FROM newer UNION ALL SELECT * FROM base WHERE sys_id NOT IN (SELECT sys_id FROM newer)
    )
    SELECT sys_id, name, department, sys_updated_on, {hash_sql(["sys_id", "name", "department"])} AS etl_hash FROM state
    """


def _streamed(d: Data, *wheres: str) -> DataFrame:
    """Orders arrive as edits of users, one stream with a checkpoint of its own for each condition.

    The stored users are older than most of the edits.
    """
    root = scratch_dir(d.spark, "stream")
    store = TableStore(d.spark, f"{root}/tables")
    base = d.usr.select("sys_id", "name", "department", F.col("sys_created_on").alias("sys_updated_on"))
    store.keyed("user").replace(sync.normalise_reference(base, "user", ORDERS_AS_OF))
    path = d.path("orders")
    files = f"{path[:-1]}[{path[-1]}]"  # a stream source wants a pattern or a folder
    for n, where in enumerate(wheres):
        edits = d.spark.readStream.schema(d.table("orders").schema).parquet(files).where(where).select(
            F.col("o_custkey").cast("string").alias("sys_id"),
            F.concat(F.lit("edit "), F.col("o_orderkey").cast("string")).alias("name"),
            F.col("o_orderpriority").alias("department"),
            F.col("o_orderdate").alias("sys_updated_on"),
            F.col("o_orderkey").alias("seq"),
        )
        incremental_stream(edits, store, "user", "user", f"{root}/checkpoint{n}", ORDERS_AS_OF, ["seq"]).awaitTermination()
        if n == 0:
            store.keyed("user").compact()
    return store.current("user").drop("etl_created_at", "etl_updated_at")


@query("incremental_stream", STREAMED)
def stream(d: Data):
    return _streamed(d, "true")


@query("incremental_stream_twice", STREAMED)
def stream_twice(d: Data):
    """The edits of two streams, whose batches have the same numbers; the second meets what the first changed."""
    return _streamed(d, "o_orderdate < DATE '1995-06-01'", "o_orderdate >= DATE '1995-06-01'")


# -- runs ---------------------------------------------------------------------


def resources(d: Data) -> dict[str, DataFrame]:
    return {
        "incident": d.incident,
        "incident_task": d.incident_task,
        "task_sla": d.task_sla,
        "task_time_worked": d.past_time_worked,
        "contract_sla": d.contract_sla,
        "user_group": d.user_group,
        "user": d.usr.drop("etl_updated_at"),
        "company": d.company.drop("etl_updated_at"),
    }


def new_run(d: Data, as_of: datetime = ORDERS_AS_OF, **kw) -> loads.Run:
    return loads.Run(d.spark, scratch_dir(d.spark, "run"), as_of, order=["seq1", "seq2", "seq3"], **kw)


def no_rows(run: loads.Run) -> DataFrame:
    return run.spark.createDataFrame([], "sys_id STRING")


#: columns whose content is compared after a run, table by table
COMPARED = {
    "contract_sla": ["sys_id", "name", "vendor", "type", "duration", "part_number"],
    "user_group": ["sys_id", "name", "parent"],
    "user": ["sys_id", "user_name", "name", "email", "company", "department", "active", "first_name", "last_name", "phone", "title"],
    "company": ["sys_id", "name", "customer", "vendor", "active"],
    "incident": RAW_FIELDS,
    "incident_task": ["sys_id", "parent", "opened_at", "state"],
    "task_sla": ["sys_id", "task"],  # copies of an id differ in the rest, and any of them may be the last
    "task_time_worked": ["sys_id", "task", "sys_created_by", "time_in_seconds"],
}


def stored_counts(run: loads.Run) -> DataFrame:
    """What is stored after a run: rows, distinct ids and a digest of the rows' content per table."""
    out = None
    for name in sorted(run.counts):
        table, columns = run.table(name), COMPARED[name]
        if table is None:  # an empty batch creates no table
            table = no_rows(run).select(*[F.lit(None).cast("string").alias(c) for c in columns])
        flags = {f.name for f in table.schema if isinstance(f.dataType, T.BooleanType)}  # shown as the resources have them
        shown = [F.col(c).cast("int") if c in flags else F.col(c) for c in columns]
        text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("-")) for c in shown])
        row = table.agg(
            F.count(F.lit(1)).alias("record_count"), F.countDistinct("sys_id").alias("ids"),
            F.sum(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")).alias("content"),
        )
        row = row.select(F.lit(name).alias("table_name"), "record_count", "ids", "content")
        out = row if out is None else out.unionByName(row)
    return out


def _count(table: str, shape: str, where: str = "true", last_by: str | None = None) -> str:
    """The same in SQL; with ``last_by`` the last row of each id counts."""
    text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in COMPARED[table])
    rows = f"SELECT * FROM {shape} WHERE {where}"
    if last_by is not None:
        rows = f"SELECT * FROM ({rows}) AS w QUALIFY row_number() OVER (PARTITION BY sys_id ORDER BY {last_by}) = 1"
    return (
        f"SELECT '{table}' AS table_name, count(*) AS record_count, count(DISTINCT sys_id) AS ids, "
        f"CAST(sum(CAST(concat('0x', substr(md5(concat_ws('|', {text})), 1, 8)) AS BIGINT)) AS BIGINT) AS content "
        f"FROM ({rows}) AS r"
    )


RECENT = "(active = 1 OR sys_updated_on >= TIMESTAMP '2001-07-03 00:00:00')"
REFERENCE_COUNTS = " UNION ALL ".join([
    _count("contract_sla", "contract_sla"),
    _count("user_group", "user_group"),
    _count("user", "usr", RECENT),
    _count("company", "company", RECENT),
])


def _incident_counts(start: str, end: str) -> str:
    text_window = f"opened_at >= '{start} 00:00:00' AND opened_at <= '{end} 23:59:59'"
    time_window = f"sys_created_on >= TIMESTAMP '{start} 00:00:00' AND sys_created_on <= TIMESTAMP '{end} 23:59:59'"
    return " UNION ALL ".join([
        _count("incident", "incident", text_window),
        _count("incident_task", "incident_task", f"{text_window} AND parent <> ''", "seq1 DESC, seq2 DESC, seq3 DESC"),
        _count("task_sla", "task_sla", f"{time_window} AND task <> ''", "task"),
        _count("task_time_worked", "past_time_worked", f"{time_window} AND task <> ''"),
    ])


WIDE = ("1995-01-01", "2001-08-01")


@query("load_reference", REFERENCE_COUNTS)
def load_reference(d: Data):
    return stored_counts(loads.load_reference(new_run(d), resources(d)))


@query("sync_reference", f"SELECT * FROM ({REFERENCE_COUNTS}) AS c WHERE table_name IN ('user', 'company')")
def sync_reference(d: Data):
    """First sync loads everything, the second finds no change."""
    run = new_run(d)
    loads.sync_reference(run, resources(d))
    loads.sync_reference(run, resources(d))
    return stored_counts(run)


@query("sync_companies", _count("company", "company", "vendor = 1 AND active = 1"))
def sync_companies(d: Data):
    return stored_counts(loads.sync_companies(new_run(d), resources(d), "vendor"))


@query("load_incidents", _incident_counts(*WIDE))
def load_incidents(d: Data):
    return stored_counts(loads.load_incidents(new_run(d), resources(d), *WIDE))


@query("run_full", f"{REFERENCE_COUNTS} UNION ALL {_incident_counts('1996-03-01', '2000-10-31')}")
def run_full(d: Data):
    return stored_counts(loads.run_full(new_run(d), resources(d), "1996-03-01", "2000-10-31"))


@query("run_daily", _incident_counts("1995-08-03", "2001-08-02"))
def run_daily(d: Data):
    run = new_run(d)
    days = (ORDERS_AS_OF - datetime(1995, 8, 3)).days
    return stored_counts(loads.run_daily(run, resources(d), days))


@query(
    "quick_sync",
    f"SELECT * FROM ({REFERENCE_COUNTS}) AS c WHERE table_name IN ('user', 'company') "
    f"UNION ALL {_incident_counts('1998-11-05', '2001-08-02')}",
)
def quick_sync(d: Data):
    return stored_counts(loads.quick_sync(new_run(d), resources(d), days=1001))


@query(
    "full_normalized",
    f"SELECT * FROM ({REFERENCE_COUNTS}) AS c WHERE table_name IN ('user', 'company') "
    f"UNION ALL {_incident_counts('1997-01-01', '1999-12-31')}",
)
def full_normalized(d: Data):
    run = new_run(d)
    return stored_counts(
        loads.full_normalized(run, resources(d), "1997-01-01", "1999-12-31", full_reference=True)
    )


IN_TIME = "sys_created_on >= TIMESTAMP '1996-03-01 00:00:00' AND sys_created_on <= TIMESTAMP '2000-10-31 23:59:59' AND task <> ''"
RUN_ROW = """
SELECT 'range' AS execution_type, 'success' AS status, CAST(90 AS DOUBLE) AS duration_seconds,
       {requests} AS total_api_requests, CAST(written AS INTEGER) AS total_records_processed,
       'contract_sla,user_group,user,company,incident,incident_task,task_sla,task_time_worked' AS tables_processed
FROM (SELECT (SELECT count(*) FROM contract_sla) + (SELECT count(*) FROM user_group)
           + (SELECT count(*) FROM usr WHERE {recent}) + (SELECT count(*) FROM company WHERE {recent})
           + (SELECT count(*) FROM incident WHERE opened_at >= '1996-03-01 00:00:00' AND opened_at <= '2000-10-31 23:59:59')
           + (SELECT count(DISTINCT sys_id) FROM incident_task WHERE parent <> '' AND opened_at >= '1996-03-01 00:00:00'
              AND opened_at <= '2000-10-31 23:59:59')
           + (SELECT count(DISTINCT sys_id) FROM task_sla WHERE {in_time})
           + (SELECT count(*) FROM past_time_worked WHERE {in_time}) AS written) AS w
"""


def _audited(d: Data, **kw) -> loads.Run:
    """A whole run of all eight resources."""
    run = new_run(d)
    clock = iter([ORDERS_AS_OF, ORDERS_AS_OF + timedelta(seconds=90)])
    return audit.run_audited(run, "range", resources(d), clock.__next__, start="1996-03-01", end="2000-10-31", **kw)


def _log(run: loads.Run) -> DataFrame:
    log = run.store.read_appended("run_log").select(
        "execution_type", "status", "duration_seconds", "total_api_requests", "total_records_processed", "tables_processed"
    )
    return double(log, "duration_seconds")


@query("run_audit", RUN_ROW.format(recent=RECENT, in_time=IN_TIME, requests="(SELECT CAST(count(*) AS INTEGER) FROM request_log)"))
def run_audit(d: Data):
    return _log(_audited(d, request_log=d.request_log))


@query(
    "run_log_append",
    """
    SELECT execution_type, status, count(*) AS runs, CAST(sum(total_records_processed) AS BIGINT) AS records FROM (
      SELECT execution_type, status, total_records_processed FROM run_log
      UNION ALL SELECT execution_type, 'appended', CAST(count(*) AS INTEGER) FROM run_log GROUP BY execution_type
    ) AS u GROUP BY execution_type, status
    """,
)
def run_log_append(d: Data):
    """Append one audit row per execution type to the log and read it back."""
    store = TableStore(d.spark, scratch_dir(d.spark, "log"))
    columns = ["execution_type", "status", "total_records_processed"]
    store.append("run_log", d.run_log.select(*columns))
    rows = d.run_log.groupBy("execution_type").agg(F.count(F.lit(1)).cast("int").alias("total_records_processed"))
    store.append("run_log", rows.withColumn("status", F.lit("appended")).select(*columns))
    return store.read_appended("run_log").groupBy("execution_type", "status").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("total_records_processed").alias("records")
    )


INCIDENT_ROWS = """
SELECT sys_id, number, state, priority, urgency, impact, short_description, opened_at, closed_at,
       coalesce(company, '') AS company, resolved_by, opened_by, caller_id
FROM incident WHERE opened_at >= '1996-03-01 00:00:00' AND opened_at <= '2000-10-31 23:59:59'
"""


@query("load_from_pages", INCIDENT_ROWS)
def load_from_pages(d: Data):
    """Landed pages through check, flattening, window and upsert, and the stored rows back."""
    path = scratch_dir(d.spark, "pages")
    pages.land_pages(raw_incidents(d), path)
    run = loads.Run(d.spark, scratch_dir(d.spark, "run"), ORDERS_AS_OF, order=["offset", "position"])
    incidents = loads.paged_resource(run, "incident", path, RAW_FIELDS)
    loads.load_incidents(run, {"incident": incidents}, "1996-03-01", "2000-10-31")
    return run.table("incident").select(*RAW_FIELDS)


def _missing_loaded(d: Data, name: str, partial: DataFrame) -> DataFrame:
    run = new_run(d)
    loads.load_incidents(run, {"incident": d.incident}, backlog=True)
    loads.load_reference(run, {name: partial.drop("etl_updated_at")})
    source = resources(d)[name]
    loads.sync_missing(run, source, name)
    return run.table(name).select("sys_id", "name")


NAMED_USERS = """
SELECT resolved_by AS id FROM incident UNION SELECT opened_by FROM incident UNION SELECT caller_id FROM incident
"""


@query(
    "sync_missing_users",
    f"SELECT sys_id, name FROM usr WHERE (department <> 'MACHINERY' AND {RECENT}) OR sys_id IN (SELECT id FROM ({NAMED_USERS}) AS n)",
)
def sync_missing_users(d: Data):
    return _missing_loaded(d, "user", d.usr.where("department <> 'MACHINERY'"))


@query(
    "sync_missing_companies",
    f"SELECT sys_id, name FROM company WHERE (vendor = 1 AND {RECENT}) OR sys_id IN (SELECT company FROM incident)",
)
def sync_missing_companies(d: Data):
    return _missing_loaded(d, "company", d.company.where("vendor = 1"))
