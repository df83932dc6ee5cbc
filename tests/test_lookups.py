import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from ticketlake.operators import integrity, lookups, sync, views


def skewed(spark, n=6000):
    """A third of the rows has one key, some have none, some are unknown."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 7 == 0, F.lit(None))
        .when(F.col("id") % 11 == 0, "ghost")
        .otherwise((F.col("id") % 50).cast("string"))
    )
    return spark.range(0, n, 1, 4).select(F.col("id").cast("string").alias("sys_id"), key.alias("ref"))


def reference(spark):
    return spark.range(45).select(F.col("id").cast("string").alias("rid"), F.concat(F.lit("n"), F.col("id")).alias("label")).union(
        spark.createDataFrame([("hot", "the hot one")], "rid STRING, label STRING")
    )


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    fact, dim = skewed(spark), reference(spark)
    plain = lookups.lookup_join(fact, dim, "ref", "rid", how, salted=False)
    salted = lookups.lookup_join(fact, dim, "ref", "rid", how, spread_by=["sys_id"], salted=True)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


def test_hot_rows_are_spread_over_salts(spark):
    fact = skewed(spark)
    assert [r[0] for r in lookups.hot_keys(fact, "ref").where("_hot = 'hot'").collect()] == ["hot"]
    plan = lookups.lookup_join(fact, reference(spark), "ref", "rid", "left", spread_by=["sys_id"], salted=True)
    assert "_salt" in plan._jdf.queryExecution().optimizedPlan().toString()


def tables(spark):
    user = spark.createDataFrame(
        [("1", "u1", "User 1", "e1"), ("2", "u2", "User 2", "e2"), ("hot", "uh", "Hot", "eh")],
        "sys_id STRING, user_name STRING, name STRING, email STRING",
    )
    company = spark.createDataFrame(
        [("c1", "Acme", "p", "x", "s", "BR")], "sys_id STRING, name STRING, phone STRING, city STRING, state STRING, country STRING"
    )
    n = 900
    pick = lambda m, k: F.when(F.col("id") % m == 0, "hot").when(F.col("id") % k == 0, F.lit(None)).when(
        F.col("id") % 13 == 0, "").otherwise((F.col("id") % 4).cast("string"))
    incident = spark.range(n).select(
        F.when(F.col("id") % 100 == 0, F.lit(None)).otherwise((F.col("id") % 800).cast("string")).alias("sys_id"),
        *[F.lit("x").alias(c) for c in ("number", "short_description", "state", "priority", "urgency", "impact", "opened_at", "closed_at")],
        F.when(F.col("id") % 2 == 0, "c1").otherwise("ghost").alias("company"),
        pick(3, 5).alias("resolved_by"), pick(2, 7).alias("opened_by"), pick(4, 9).alias("caller_id"),
    )
    return incident, company, user


def test_large_reference_path_gives_the_same_view(spark):
    """Repeated and missing incident ids included."""
    args = tables(spark)
    assert rows(views.incident_enriched(*args, narrow=True)) == rows(views.incident_enriched(*args, narrow=False))
    assert rows(views.incident_summary(*args, narrow=True)) == rows(views.incident_summary(*args, narrow=False))


def test_size_check_follows_the_session_threshold(spark, data):
    assert lookups.fits_broadcast(data.company)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not lookups.fits_broadcast(data.company)
        salted = rows(views.users_with_company(data.usr, data.company))
        orphans = rows(integrity.orphan_users(data.usr, data.company))
        enriched = rows(views.incident_enriched(data.incident, data.company, data.usr))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert salted == rows(views.users_with_company(data.usr, data.company))
    assert orphans == rows(integrity.orphan_users(data.usr, data.company))
    assert enriched == rows(views.incident_enriched(data.incident, data.company, data.usr))


def test_null_id_in_the_reference_does_not_hide_missing_ids(spark):
    incident = spark.createDataFrame([("1", "a"), ("2", ""), ("3", None), ("4", "b")], "sys_id STRING, company STRING")
    company = spark.createDataFrame([("a",), (None,)], "sys_id STRING")
    assert rows(integrity.missing_company_ids(incident, company)) == [("",), ("b",)]
    assert rows(integrity.missing_company_ids(incident, company, ignore_empty=True)) == [("b",)]
    assert integrity.orphan_incidents(incident, company).first()[0] == 2


def test_missing_users_take_their_roles_as_a_parameter(spark):
    incident = spark.createDataFrame([("1", "a", "b", "c", "z")], "sys_id STRING, resolved_by STRING, opened_by STRING, caller_id STRING, closed_by STRING")
    user = spark.createDataFrame([("a",)], "sys_id STRING")
    assert rows(integrity.missing_user_ids(incident, user)) == [("b",), ("c",)]
    assert rows(integrity.missing_user_ids(incident, user, ["closed_by"])) == [("z",)]


def test_changed_rows_without_a_table_are_all_new(spark):
    incoming = spark.createDataFrame([("1", "h")], "sys_id STRING, etl_hash STRING")
    assert rows(sync.changed_rows(incoming, None)) == [("1", "h", "new")]
    stored = spark.createDataFrame([("1", None), (None, "h")], "sys_id STRING, etl_hash STRING")
    assert rows(sync.changed_rows(incoming, stored)) == [("1", "h", "modified")]


def test_repeated_reference_ids_give_whole_rows_on_both_paths(spark):
    fact = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", None), ("4", "gone")], "sys_id STRING, ref STRING")
    dim = spark.createDataFrame([("a", "x", "9"), ("a", "y", "1"), ("b", "z", None)], "sys_id STRING, name STRING, email STRING")
    found = [
        rows(lookups.resolve_roles(fact, dim, {"ref": "r"}, {"name": "name", "email": "email"}, narrow=narrow))
        for narrow in (False, True)
    ]
    assert found[0] == found[1] == [("1", "a", "y", "1"), ("2", "b", "z", None), ("3", None, None, None), ("4", "gone", None, None)]
