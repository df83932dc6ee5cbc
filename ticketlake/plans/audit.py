"""Audited execution: every run leaves one row in the run log."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.operators import apilog
from ticketlake.operators.normalize import project_schema
from ticketlake.operators.runlog import RETENTION_DAYS, run_duration
from ticketlake.plans.loads import Run, execute
from ticketlake.schemas import RUN_LOG


def audit_row(
    run: Run,
    execution_type: str,
    status: str,
    ended_at: datetime,
    started_at: datetime | None = None,
    start=None,
    end=None,
    error: str | None = None,
    request_log: DataFrame | None = None,
    db_seconds: float = 0,
    hostname: str | None = None,
    username: str | None = None,
) -> DataFrame:
    """One run-log row from what the run observed; without ``started_at`` the run began at its as-of time."""
    started_at = started_at or run.as_of
    written = sum(m["insert"] + m["update"] for m in run.merged.values())
    known = {
        "execution_id": run.execution_id,
        "execution_type": execution_type,
        "start_date": str(start) if start else None,
        "end_date": str(end) if end else None,
        "started_at": started_at.isoformat(sep=" "),
        "ended_at": ended_at.isoformat(sep=" "),
        "status": status,
        "json_storage_enabled": str(run.json_storage).lower(),
        "total_db_transactions": str(len(run.merged)),
        "total_records_processed": str(written),
        "db_time_seconds": str(db_seconds),
        "tables_processed": ",".join(run.counts),
        "error_message": error,
        "records_by_table": json.dumps(run.counts),
        "hostname": hostname,
        "username": username,
        "created_at": ended_at.isoformat(sep=" "),
    }
    base = run.spark.range(1).select(*[F.lit(v).cast("string").alias(k) for k, v in known.items()])
    if request_log is not None:
        totals = apilog.api_totals(request_log, (ended_at - started_at).total_seconds())
        base = base.select(
            "*",
            *[
                totals.select(F.round(F.col(src).cast("decimal(20,6)"), 2).cast("string")).scalar().alias(dst)
                for src, dst in (
                    ("total_requests", "total_api_requests"),
                    ("failed_requests", "failed_api_requests"),
                    ("total_api_time", "total_api_time_seconds"),
                    ("success_rate", "api_success_rate"),
                )
            ],
        )
        for c in ("total_api_requests", "failed_api_requests"):
            base = base.withColumn(c, F.col(c).cast("decimal(20,2)").cast("int").cast("string"))
    entry = run.store.read("archive_entry")
    if run.json_storage and entry is not None:
        newest = entry.orderBy(F.desc("created_at"), F.desc("id")).limit(1)
        base = base.select(
            "*",
            *[
                newest.select(F.col(c).cast("string")).scalar().alias(c)
                for c in ("json_size_kb", "compressed_size_kb", "compression_ratio")
            ],
        )
    row = project_schema(base, RUN_LOG)
    return row.withColumn("duration_seconds", run_duration(F.col("started_at"), F.col("ended_at")).cast("decimal(10,2)"))


def append_run(run: Run, row: DataFrame) -> None:
    run.store.append("run_log", row, month_of="started_at")


def cut_log(run: Run, as_of: datetime, days: int = RETENTION_DAYS) -> int:
    """Remove the runs of the stored log that began more than ``days`` days ago; returns how many."""
    return run.store.cut("run_log", "started_at", as_of - timedelta(days=days))


def run_audited(
    run: Run,
    mode: str,
    resources: dict[str, DataFrame],
    clock: Callable[[], datetime] = datetime.now,
    request_log: DataFrame | None = None,
    **options,
) -> Run:
    """Execute a mode and log it: success, partial (rows were rejected) or failed.

    The clock is read at both ends: a run for a past as-of time lasts as long as it takes.
    """
    start, end = options.get("start"), options.get("end")
    log = {"started_at": clock(), "start": start, "end": end, "request_log": request_log}
    try:
        execute(run, mode, resources, **options)
    except Exception as error:
        append_run(run, audit_row(run, mode, "failed", clock(), error=str(error), db_seconds=round(run.write_seconds, 2), **log))
        raise
    append_run(run, audit_row(run, mode, "partial" if run.rejected else "success", clock(), db_seconds=round(run.write_seconds, 2), **log))
    return run
