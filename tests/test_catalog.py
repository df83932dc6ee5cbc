from datetime import datetime, timedelta

from tests.conftest import rows
from ticketlake.plans import audit, catalog, loads
from ticketlake_queries.loads import resources

AS_OF = datetime(2001, 8, 2, 6)


def test_reports_in_sql_over_a_loaded_store(spark, data, tmp_path):
    run = loads.Run(spark, str(tmp_path), AS_OF, json_storage=True, order=["seq1", "seq2", "seq3"])
    audit.run_audited(run, "range", resources(data), lambda: AS_OF + timedelta(seconds=5), start="1995-01-01", end="2001-08-01")
    names = catalog.register_views(run)
    assert {"incident_summary", "users_with_company", "archive_summary", "run_summary", "task_sla"} <= set(names)
    sql = spark.sql
    assert sql("SELECT count(*) FROM incident").first()[0] == 1500
    assert sql("SELECT * FROM incident_summary WHERE state = '6'").count() == 493
    by_company = sql("SELECT company, count(*) AS n FROM incident GROUP BY company")
    assert sum(r["n"] for r in by_company.collect()) == 1500
    top = sql("SELECT * FROM companies_with_stats ORDER BY user_count DESC, sys_id LIMIT 3").collect()
    assert [r["user_count"] for r in top] == sorted((r["user_count"] for r in top), reverse=True)
    assert sql("SELECT * FROM users_with_company WHERE active = 1").count() > 0
    assert sql("SELECT status FROM recent_runs").first()[0] == "success"
    assert sql("SELECT effective_size_kb, days_old FROM archive_summary").first()["days_old"] == 0
    joined = sql(
        "SELECT i.sys_id, c.name FROM incident i LEFT JOIN company c ON i.company = c.sys_id"
    )
    assert rows(joined) == rows(sql("SELECT sys_id, company_name FROM incident_enriched"))


def test_views_of_an_empty_store(spark, tmp_path):
    run = loads.Run(spark, str(tmp_path), AS_OF)
    catalog.register_views(run)
    assert spark.sql("SELECT * FROM incident_enriched").count() == 0
