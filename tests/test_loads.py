from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from ticketlake.plans import audit, loads
from ticketlake.schemas import REQUEST_LOG
from ticketlake.sources import archive_files
from ticketlake.sources.keyed import bits, bucket_bitmap, bucket_of

AS_OF = datetime(2001, 8, 2, 6)
INCIDENT_TABLES = ("incident", "incident_task", "task_sla")


def resources(data):
    from ticketlake_queries.loads import resources as shaped

    return shaped(data)


def new_run(spark, path, **kw):
    return loads.Run(spark, str(path), AS_OF, order=["seq1", "seq2", "seq3"], **kw)


def test_days_together_equal_the_range(spark, data, tmp_path):
    daily = loads.run_daily(new_run(spark, tmp_path / "a", json_storage=True), resources(data), days=25)
    ranged = loads.load_incidents(new_run(spark, tmp_path / "b"), resources(data), "2001-07-08", "2001-08-02")
    assert daily.counts == ranged.counts and daily.counts["incident"] > 0
    for name in INCIDENT_TABLES:
        stamp = [c for c in daily.table(name).columns if c.startswith("etl_")]
        assert rows(daily.table(name).drop(*stamp)) == rows(ranged.table(name).drop(*stamp))
    entries = daily.table("archive_entry")
    days = daily.table("incident").select(F.substring("opened_at", 1, 10)).distinct().count()
    assert entries.count() == days == entries.select("start_date").distinct().count()
    assert {r["extraction_type"] for r in entries.collect()} == {"daily"}


def test_saving_a_window_again_replaces_its_archive_entry(spark, data, tmp_path):
    run = new_run(spark, tmp_path, json_storage=True)
    for _ in range(2):
        run = loads.Run(spark, str(tmp_path), AS_OF, True, run.order)
        loads.load_incidents(run, resources(data), "2001-01-01", "2001-06-30")
    entry = run.table("archive_entry").collect()
    assert len(entry) == 1 and entry[0]["extraction_type"] == "range"
    assert entry[0]["record_count"] == sum(run.counts.values())
    records = archive_files.load_latest(spark, run.table("archive_entry"), run.archive_root, AS_OF, "range")
    assert records.where("table = 'incident'").count() == run.counts["incident"]
    assert run.merged["incident"] == {"insert": 0, "update": 0, "unchanged": run.counts["incident"]}


def test_without_incidents_nothing_else_is_loaded(spark, data, tmp_path):
    run = loads.load_incidents(new_run(spark, tmp_path), resources(data), "2031-01-01", "2031-01-02")
    assert run.counts == {"incident": 0} and run.table("incident_task") is None
    run = loads.load_incidents(new_run(spark, tmp_path / "g"), resources(data), "2031-01-01", "2031-01-02", gate=False)
    assert set(run.counts) == {"incident", "incident_task", "task_sla", "task_time_worked"}


def test_backlog_loads_everything(spark, data, tmp_path):
    run = loads.execute(new_run(spark, tmp_path), "backlog", {"incident": data.incident})
    assert run.counts["incident"] == data.incident.count()


def test_a_batch_rewrites_only_buckets_with_changes(spark, data, tmp_path):
    loads.load_incidents(new_run(spark, tmp_path), {"incident": data.incident}, "1995-01-01", "2001-08-02")
    table = new_run(spark, tmp_path).keyed("incident")
    first = table.state()
    table.replace(table.read(first), buckets=32, based_on=first)
    before = table.state()
    edited = data.incident.withColumn("state", F.when(F.col("sys_id") == "1", "edited").otherwise(F.col("state")))
    run = loads.load_incidents(new_run(spark, tmp_path), {"incident": edited}, "1995-01-01", "2001-08-02")
    after = table.state()
    assert [b for b in before.base if before.base[b] != after.base[b]] == bits(
        spark.sql("SELECT '1' AS sys_id").agg(bucket_bitmap(bucket_of("sys_id", 32))).first()[0]
    )
    assert run.merged["incident"] == {"insert": 0, "update": 1, "unchanged": run.counts["incident"] - 1}
    assert run.table("incident").where("state = 'edited'").count() == 1
    again = loads.load_incidents(new_run(spark, tmp_path), {"incident": edited}, "1995-01-01", "2001-08-02")
    assert again.merged["incident"]["unchanged"] == run.counts["incident"] and table.state().number == after.number


def test_rejected_rows_are_kept_apart_and_the_run_is_partial(spark, data, tmp_path):
    bad = data.company_raw.withColumn("sys_updated_on", F.lit("2001-08-01 00:00:00")).withColumn("active", F.lit("true"))
    clock = iter([AS_OF, AS_OF + timedelta(seconds=3)])
    run = audit.run_audited(new_run(spark, tmp_path), "config", {"company": bad}, clock.__next__)
    rejected = loads.rejects(run, "company")
    assert run.rejected == rejected.count() > 0
    assert run.table("company").count() == run.counts["company"] - run.rejected
    log = run.store.read_appended("run_log").first()
    assert (log["status"], float(log["duration_seconds"])) == ("partial", 3)


def test_failure_is_logged_and_raised(spark, data, tmp_path):
    run = new_run(spark, tmp_path)
    broken = {"incident": data.incident.drop("opened_at")}
    with pytest.raises(Exception):
        audit.run_audited(run, "today", broken, lambda: AS_OF)
    log = run.store.read_appended("run_log").first()
    assert log["status"] == "failed" and log["error_message"] and log["execution_id"] == run.execution_id


def test_audit_row_of_a_json_run(spark, data, tmp_path):
    run = new_run(spark, tmp_path, json_storage=True)
    audit.run_audited(
        run, "custom", {"incident": data.incident}, lambda: AS_OF + timedelta(seconds=10), data.request_log,
        start="2001-01-01", end="2001-06-30",
    )
    log = run.store.read_appended("run_log").first()
    entry = run.table("archive_entry").first()
    assert log["json_storage_enabled"] and log["json_size_kb"] == entry["json_size_kb"]
    assert log["total_api_requests"] == data.request_log.count()
    assert log["records_by_table"] == f'{{"incident": {run.counts["incident"]}}}'
    assert str(log["start_date"]) == "2001-01-01" and log["tables_processed"] == "incident"


def test_incremental_reference_sync_takes_only_changes(spark, data, tmp_path):
    users = {"user": data.usr.drop("etl_updated_at")}
    run = loads.sync_reference(new_run(spark, tmp_path), users)
    again = loads.Run(spark, str(tmp_path), AS_OF + timedelta(days=1))
    edited = users["user"].withColumn(
        "name", F.when(F.col("sys_id") == "1", "renamed").otherwise(F.col("name"))
    ).withColumn("sys_updated_on", F.lit(AS_OF + timedelta(hours=2)).cast("timestamp_ntz"))
    loads.sync_reference(again, {"user": edited})
    assert again.counts["user"] - run.counts["user"] <= data.usr.count()
    table = again.table("user")
    assert table.where("sys_id = '1'").first()["name"] == "renamed"
    assert table.where("name = 'renamed'").count() == 1
    untouched = again.merged["user"]
    # Inactive users of the past were not loaded at first; now they are new.
    assert untouched["update"] == 1 and table.count() == run.table("user").count()


def test_unknown_company_type(spark, data, tmp_path):
    with pytest.raises(ValueError):
        loads.sync_companies(new_run(spark, tmp_path), resources(data), "partner")


def test_a_run_for_a_past_time_is_logged_with_its_real_duration(spark, data, tmp_path):
    run = audit.run_audited(new_run(spark, tmp_path), "backlog", {"incident": data.incident})
    row = run.store.read_appended("run_log").first()
    assert row["status"] == "success" and 0 < float(row["duration_seconds"]) < 3600
    assert 0 < float(row["db_time_seconds"]) <= float(row["duration_seconds"])


@pytest.mark.parametrize("copies", [1, 2])
def test_missing_references_take_the_last_copy(spark, data, tmp_path, copies):
    """Two versions of a user, in either order of the rows."""
    run = new_run(spark, tmp_path)
    loads.load_incidents(run, {"incident": data.incident.limit(50)}, backlog=True)
    wanted = data.incident.limit(50).where("opened_by IS NOT NULL").first()["opened_by"]
    versions = [(wanted, "old", 1), (wanted, "new", 2)]
    source = spark.createDataFrame(versions[:: 3 - 2 * copies], "sys_id STRING, name STRING, seq1 INT")
    loads.sync_missing(run, source, "user")
    assert [r["name"] for r in run.table("user").collect()] == ["new"]


def test_old_runs_are_cut_from_the_stored_log(spark, tmp_path):
    run = new_run(spark, tmp_path)
    for day in (datetime(2001, 3, 31), datetime(2001, 5, 1), datetime(2001, 5, 3, 23), datetime(2001, 5, 4, 7), datetime(2001, 8, 1)):
        audit.append_run(run, audit.audit_row(run, "daily", "success", day + timedelta(minutes=1), started_at=day))
    march = set((tmp_path / "tables/run_log/rows/_month=2001-03").iterdir())
    august = set((tmp_path / "tables/run_log/rows/_month=2001-08").iterdir())
    assert march and audit.cut_log(run, AS_OF, days=90) == 3  # the cutoff is 2001-05-04 06:00
    left = sorted(str(r["started_at"]) for r in run.store.read_appended("run_log").collect())
    assert left == ["2001-05-04 07:00:00", "2001-08-01 00:00:00"]
    assert not (tmp_path / "tables/run_log/rows/_month=2001-03").exists()
    assert set((tmp_path / "tables/run_log/rows/_month=2001-08").iterdir()) == august  # untouched
    assert audit.cut_log(run, AS_OF, days=90) == 0


def test_request_time_of_a_large_run_is_logged_beside_older_rows(spark, tmp_path):
    """More than 10^8 seconds over all requests; rows of earlier runs were stored with a narrower type."""
    run, column = new_run(spark, tmp_path), "total_api_time_seconds"
    requests = spark.createDataFrame([("user", n, 99_999_999.25, 0) for n in range(3)], REQUEST_LOG)
    small = spark.createDataFrame([("user", 1, 1.25, 0)], REQUEST_LOG)
    for day, log in ((datetime(2001, 5, 1), small), (datetime(2001, 5, 5), small), (datetime(2001, 8, 1), requests)):
        row = audit.audit_row(run, "daily", "success", day + timedelta(minutes=1), started_at=day, request_log=log)
        audit.append_run(run, row if log is requests else row.withColumn(column, F.col(column).cast("decimal(10,2)")))
    times = [r[column] for r in run.store.read_appended("run_log").orderBy("started_at").collect()]
    assert times == [Decimal("1.25"), Decimal("1.25"), Decimal("299999997.75")]
    assert audit.cut_log(run, AS_OF, days=90) == 1
    audit.append_run(run, audit.audit_row(run, "daily", "success", datetime(2001, 5, 6), request_log=requests, started_at=datetime(2001, 5, 6)))
    times = [r[column] for r in run.store.read_appended("run_log").orderBy("started_at").collect()]
    assert times == [Decimal("1.25"), Decimal("299999997.75"), Decimal("299999997.75")]


def test_a_run_with_much_request_time_succeeds(spark, data, tmp_path):
    requests = spark.createDataFrame([("user_group", n, 99_999_999.25, n) for n in range(2)], REQUEST_LOG)
    run = audit.run_audited(new_run(spark, tmp_path), "config", {"user_group": data.user_group}, lambda: AS_OF, requests)
    log = run.store.read_appended("run_log").first()
    assert (log["status"], log["total_api_time_seconds"]) == ("success", Decimal("199999998.50"))
    assert (log["total_api_requests"], log["failed_api_requests"]) == (2, 1)
