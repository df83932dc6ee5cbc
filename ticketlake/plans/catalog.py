"""Stored tables and the reports over them as SQL views of the session."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ticketlake.operators import archive, runlog, views
from ticketlake.operators.normalize import project_schema
from ticketlake.plans.loads import Run
from ticketlake.schemas import INCIDENT_FIELDS, strings, typed_schema


def _shown(table: str) -> T.StructType:
    """A typed table's columns; flags are shown as 1/0, so that ``active = 1`` works."""
    flag = lambda f: T.IntegerType() if isinstance(f.dataType, T.BooleanType) else f.dataType
    return T.StructType([T.StructField(f.name, flag(f)) for f in typed_schema(table)])


TABLE_VIEWS = {"incident": strings(INCIDENT_FIELDS), "user_account": _shown("user"), "company": _shown("company")}
STORED_AS = {"user_account": "user"}


def _table(run: Run, view: str) -> DataFrame:
    """A stored table with all its declared columns; empty if nothing was loaded yet."""
    schema = TABLE_VIEWS[view]
    stored = run.table(STORED_AS.get(view, view))
    return run.spark.createDataFrame([], schema) if stored is None else project_schema(stored, schema)


def register_views(run: Run) -> list[str]:
    """Create the views; returns their names.

    Tables: incident, user_account, company, and those of incident_task,
    task_sla, task_time_worked, contract_sla, user_group, archive_entry and
    run_log that exist.  Reports: users_with_company, companies_with_stats,
    incident_enriched, incident_summary, archive_summary, run_summary,
    recent_runs.
    """
    incident, user, company = (_table(run, n) for n in ("incident", "user_account", "company"))
    found = {
        "incident": incident,
        "user_account": user,
        "company": company,
        "users_with_company": views.users_with_company(user, company),
        "companies_with_stats": views.companies_with_stats(company, user),
        "incident_enriched": views.incident_enriched(incident, company, user),
        "incident_summary": views.incident_summary(incident, company, user),
    }
    for name in ("incident_task", "task_sla", "task_time_worked", "contract_sla", "user_group"):
        table = run.table(name)
        if table is not None:
            found[name] = table
    entries = run.store.read("archive_entry")
    if entries is not None:
        found["archive_entry"] = entries
        found["archive_summary"] = archive.summary(entries, run.as_of)
    log = run.store.read_appended("run_log")
    if log is not None:
        found["run_log"] = log
        found["run_summary"] = runlog.run_summary(log)
        found["recent_runs"] = runlog.recent_runs(log)
    for name, df in found.items():
        df.createOrReplaceTempView(name)
    return sorted(found)
