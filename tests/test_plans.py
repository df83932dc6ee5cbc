"""What the optimiser makes of the queries."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR


def plan(spark, name, mode="executedPlan"):
    df = entry.queries()[name](spark, SF_DIR)
    return getattr(df._jdf.queryExecution(), mode)().toString()


@pytest.mark.parametrize("name", ["orphan_users", "orphan_incidents", "childless_companies", "missing_user_ids", "missing_company_ids"])
def test_missing_references_are_anti_joins(spark, name):
    text = plan(spark, name)
    assert "LeftAnti" in text and "LeftOuter" not in text


@pytest.mark.parametrize("name", ["incident_enriched", "incident_summary", "users_with_company"])
def test_small_dimensions_are_broadcast(spark, name):
    text = plan(spark, name)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_summary_reads_only_what_it_shows(spark):
    text = plan(spark, "incident_summary")
    assert "o_totalprice" not in text and "c_acctbal" not in text and "s_acctbal" not in text


@pytest.mark.parametrize("name", ["sla_scan", "time_worked_scan", "default_window", "run_perf_7d"])
def test_windows_are_pushed_to_the_scan(spark, name):
    assert "GreaterThanOrEqual" in plan(spark, name).split("PushedFilters")[1]


@pytest.mark.parametrize("name", ["dedup_keep_first", "dedup_last_wins", "reference_full_scan"])
def test_copies_of_a_key_are_cut_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert "WindowGroupLimit" in text and "Partial" in text.split("Exchange", 1)[1]


@pytest.mark.parametrize("name", ["top_companies", "recent_runs", "recent_runs_n", "archive_recent5", "run_log_scan"])
def test_top_n_is_not_a_full_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)
