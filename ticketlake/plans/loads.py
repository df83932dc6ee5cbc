"""Load runs: reference data, incidents, whole runs, daily runs, quick syncs.

A run reads its resources once, lands the batch as Parquet, and takes the
upsert, the archive and the counts from there.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ticketlake.functions.periods import default_window, run_window, to_day
from ticketlake.operators.archive import replace_slice, replace_windows
from ticketlake.operators.dedup import last_wins
from ticketlake.operators.integrity import missing_company_ids, missing_user_ids
from ticketlake.operators.normalize import (
    add_row_hash,
    audit_stamp,
    conform_present,
    declared_schema,
    flatten_refs,
    normalize_flags,
    with_reject_reasons,
)
from ticketlake.operators.sync import CHANGE, incremental_changes, normalise_reference, reference_by_ids, reference_full_scan
from ticketlake.schemas import PAGE_LIMIT, TYPED_STORAGE, TYPED_TABLES
from ticketlake.session import together
from ticketlake.sources import archive_files, scans
from ticketlake.sources.keyed import KeyedTable, bits, bucket_bitmap, bucket_of
from ticketlake.sources.pages import assert_complete, paged_scan
from ticketlake.sources.tables import TableStore

REASON = "reject_reason"
INCIDENT_TABLES = {
    "incident": "opened_at",
    "incident_task": "opened_at",
    "task_sla": "sys_created_on",
    "task_time_worked": "sys_created_on",
}


@dataclass
class Run:
    """One execution: where it writes, its as-of time, and what it did."""

    spark: SparkSession
    root: str
    as_of: datetime
    json_storage: bool = False
    order: list[str] = field(default_factory=list)  # columns that rank the copies of a record
    coverage: dict[str, Observation] = field(default_factory=dict)  # page checks of paged resources
    page_limits: dict[str, int] = field(default_factory=dict)
    execution_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    counts: dict[str, int] = field(default_factory=dict)
    merged: dict[str, dict[str, int]] = field(default_factory=dict)
    landed: dict[str, int] = field(default_factory=dict)  # good rows of the newest batches
    touched: dict[str, tuple[int, list[int]]] = field(default_factory=dict)  # and their buckets
    rejected: int = 0
    write_seconds: float = 0.0  # spent storing tables

    @property
    def store(self) -> TableStore:
        return TableStore(self.spark, f"{self.root}/tables")

    def table(self, name: str) -> DataFrame | None:
        """A table as of now."""
        return self.store.current(name)

    def keyed(self, name: str) -> KeyedTable:
        return self.store.keyed(name, sort_by=INCIDENT_TABLES.get(name))

    @property
    def archive_root(self) -> str:
        return f"{self.root}/archive"

    @property
    def landing(self) -> TableStore:
        return TableStore(self.spark, f"{self.root}/landing/{self.execution_id}")


def land(run: Run, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Write the batch and return its good rows.

    Typed tables are checked on the way: a row that breaks a column rule stays
    in the landing area with its reason and is not loaded.  While they are
    written, rows are counted, and noted which buckets of the stored table they
    belong to.
    """

    def write(name: str, df: DataFrame) -> tuple[DataFrame, dict]:
        if name in TYPED_TABLES:
            df = with_reject_reasons(df, name)
        else:
            df = df.withColumn(REASON, F.lit(None).cast("string"))
        seen, state = Observation(), run.keyed(name).state()
        counts = [F.count(F.lit(1)).alias("rows"), F.count(REASON).alias("rejected")]
        if state is not None:
            good = F.col(REASON).isNull()
            counts.append(bucket_bitmap(bucket_of("sys_id", state.buckets), good).alias("touched"))
        rows = run.landing.publish(name, df.observe(seen, *counts))
        if name in run.coverage:
            assert_complete(run.coverage[name].get, run.page_limits.get(name, PAGE_LIMIT))
        if state is not None:
            run.touched[name] = (state.buckets, bits(seen.get["touched"]))
        return rows, seen.get

    landed = {}
    for name, (rows, seen) in together({n: partial(write, n, df) for n, df in tables.items()}).items():
        landed[name] = rows.where(F.col(REASON).isNull()).drop(REASON)
        run.counts[name] = run.counts.get(name, 0) + seen["rows"]
        run.landed[name] = seen["rows"] - seen["rejected"]
        run.rejected += seen["rejected"]
    return landed


def paged_resource(run: Run, name: str, path: str, fields: list[str], limit: int = PAGE_LIMIT) -> DataFrame:
    """A resource from its landed pages, as a run takes it.

    The records keep their page offset and position, which rank the copies of a
    record if the run's ``order`` names them.  The pages are checked while the
    records are landed; a lost, cut or repeated page ends the run before
    anything is stored.
    """
    seen = run.coverage[name] = Observation()
    run.page_limits[name] = limit
    return flatten_refs(paged_scan(run.spark, path, limit, coverage=seen), fields)


def sync_missing(run: Run, source: DataFrame, name: str) -> Run:
    """Fetch and store the users or companies that stored incidents name and the table lacks."""
    incident, known = run.table("incident"), run.table(name)
    if incident is None:
        return run
    if known is None:
        known = run.spark.createDataFrame([], "sys_id STRING")
    find = {"user": missing_user_ids, "company": missing_company_ids}[name]
    order = [c for c in run.order if c in source.columns]
    fetched = reference_by_ids(source, find(incident, known))
    newest = last_wins(fetched, "sys_id", order).drop(*order) if order else fetched.dropDuplicates(["sys_id"])
    rows = normalise_reference(newest, name, run.as_of)
    save(run, land(run, {name: rows}))
    return run


def rejects(run: Run, name: str) -> DataFrame:
    """Rows of a landed table that were not loaded, with their reasons."""
    return run.landing.read(name).where(F.col(REASON).isNotNull())


def save(run: Run, tables: dict[str, DataFrame]) -> None:
    """Upsert every landed batch that has rows."""
    filled = {name: batch for name, batch in tables.items() if run.landed.get(name)}
    began = time.monotonic()
    run.merged.update(together({name: partial(_upsert, run, name, batch) for name, batch in filled.items()}))
    run.write_seconds += time.monotonic() - began


def _upsert(run: Run, name: str, batch: DataFrame) -> dict[str, int]:
    """One table; what the merge did is counted while it is written."""
    # Rows are applied in order, so the last copy of a key wins.  Without a rank
    # column the place in the landed files, which stay as they are, is the order.
    order = [c for c in run.order if c in batch.columns]
    if not order:
        batch, order = batch.withColumn("_rank", F.monotonically_increasing_id()), ["_rank"]
    declared = None
    if name in TYPED_STORAGE:
        batch, declared = conform_present(batch, name, run.as_of, order), declared_schema(name, run.as_of)
    else:  # stored as text, as the resources deliver it
        batch = batch.select(*[F.col(c) if c in order else F.col(c).cast("string").alias(c) for c in batch.columns])
    return run.keyed(name).merge(batch, order, touched=run.touched.get(name), declared=declared)


def load_reference(run: Run, resources: dict[str, DataFrame]) -> Run:
    """Contracts, groups, users and companies, in full."""
    tables = {name: resources[name] for name in ("contract_sla", "user_group") if name in resources}
    for name in ("user", "company"):
        if name in resources:
            order = [c for c in run.order if c in resources[name].columns]
            tables[name] = reference_full_scan(resources[name], name, run.as_of, order)
    save(run, land(run, tables))
    return run


def load_incidents(
    run: Run, resources: dict[str, DataFrame], start=None, end=None, *, backlog: bool = False, gate: bool = True
) -> Run:
    """Incidents of a window, then their tasks, SLAs and time worked.

    Without incidents nothing else is loaded (``gate``).  ``backlog`` loads
    everything, without a window.
    """
    low, high = (None, None) if backlog else default_window(start, end, as_of=run.as_of)
    batch = scans.incident_scan(resources["incident"], low, high, keep=run.order)
    landed = land(run, {"incident": batch})
    if not run.counts["incident"] and gate:
        return run
    related = {}
    if "incident_task" in resources:
        related["incident_task"] = audit_stamp(scans.task_scan(resources["incident_task"], low, high), run.as_of)
    if "task_sla" in resources:
        related["task_sla"] = audit_stamp(scans.sla_scan(resources["task_sla"], low, high), run.as_of)
    if "task_time_worked" in resources:
        related["task_time_worked"] = scans.time_worked_scan(resources["task_time_worked"], low, high)
    landed.update(land(run, related))
    save(run, landed)
    if run.json_storage:
        kind = "daily" if start == end else "range"
        archive(run, landed, "backlog" if backlog else kind, None if backlog else start, None if backlog else end)
    return run


def archive(run: Run, tables: dict[str, DataFrame], kind: str, start=None, end=None) -> None:
    """Save one archive entry and replace the slice it stands for."""
    entry = archive_files.save_entry(
        run.spark, tables, run.archive_root, kind, start, end, as_of=run.as_of
    )

    def listed(entries: DataFrame | None) -> DataFrame:
        return entry if entries is None else replace_slice(entries, entry, kind, start, end, as_of=run.as_of)

    run.store.update("archive_entry", listed)


def run_full(run: Run, resources: dict[str, DataFrame], start=None, end=None, *, backlog: bool = False) -> Run:
    """Reference data, then incidents; the first failure ends the run."""
    load_reference(run, resources)
    return load_incidents(run, resources, start, end, backlog=backlog)


def run_daily(run: Run, resources: dict[str, DataFrame], days: int = 3) -> Run:
    """The last ``days`` + 1 days.

    A record belongs to one day, so the days are upserted together, in one pass
    over the tables; the archive gets one entry per day that has incidents.
    """
    slices = run_window("daily", as_of=run.as_of, days=days)
    store_json, run.json_storage = run.json_storage, False
    try:
        load_incidents(run, resources, slices[0][0], slices[-1][1])
    finally:
        run.json_storage = store_json
    if store_json and run.counts["incident"]:
        landed = {name: run.landing.read(name).drop(REASON) for name in INCIDENT_TABLES if run.landing.exists(name)}
        days = {name: INCIDENT_TABLES[name] for name in landed}
        entries = archive_files.save_days(run.spark, landed, run.archive_root, days, "incident", as_of=run.as_of)
        run.store.update("archive_entry", lambda old: entries if old is None else replace_windows(old, entries))
    return run


def sync_reference(run: Run, resources: dict[str, DataFrame], full: bool = False) -> Run:
    """Users and companies: changes since the last sync, or everything."""
    if full:
        return load_reference(run, {k: resources[k] for k in ("user", "company") if k in resources})
    for name in ("user", "company"):
        if name not in resources:
            continue
        stored = run.table(name)
        if stored is None:
            load_reference(run, {name: resources[name]})
            continue
        order = [c for c in run.order if c in resources[name].columns]
        changes = incremental_changes(resources[name], stored, name, run.as_of, order)
        save(run, land(run, {name: changes.drop(CHANGE)}))
    return run


def full_normalized(run: Run, resources: dict[str, DataFrame], start, end, *, full_reference: bool = False) -> Run:
    """Reference sync, then the incidents of a period."""
    sync_reference(run, resources, full=full_reference)
    return load_incidents(run, resources, start, end)


def quick_sync(run: Run, resources: dict[str, DataFrame], days: int = 1) -> Run:
    """Reference sync, then the incidents of the last days."""
    today = to_day(run.as_of)
    return full_normalized(run, resources, today - timedelta(days=days), today)


def sync_companies(run: Run, resources: dict[str, DataFrame], company_type: str = "customer") -> Run:
    """Active companies of one type."""
    rows = audit_stamp(normalize_flags(scans.companies_by_type(resources["company"], company_type)), run.as_of)
    save(run, land(run, {"company": add_row_hash(rows)}))
    return run


def execute(run: Run, mode: str, resources: dict[str, DataFrame], **options) -> Run:
    """Run one mode by its name."""
    if mode == "config":
        return load_reference(run, resources)
    if mode == "daily":
        return run_daily(run, resources, options.get("days", 3))
    if mode == "quick-sync":
        return quick_sync(run, resources, options.get("days", 1))
    if mode == "sync-ref":
        return sync_reference(run, resources, options.get("full", False))
    if mode == "sync-companies":
        return sync_companies(run, resources, options.get("company_type", "customer"))
    if mode == "etl-new":
        return full_normalized(
            run, resources, options["start"], options["end"], full_reference=options.get("full", False)
        )
    mode = "range" if mode in ("period", "custom") else mode
    [(start, end)] = run_window(mode, as_of=run.as_of, start=options.get("start"), end=options.get("end"))
    return run_full(run, resources, start, end, backlog=mode == "backlog")
