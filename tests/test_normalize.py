import json
from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from ticketlake.functions import columns as C
from ticketlake.operators import normalize as N
from ticketlake.operators.profile import column_profile
from ticketlake.schemas import COMPANY, TYPED_TABLES, typed_schema
from ticketlake.sources.pages import parse_envelope

AS_OF = datetime(2024, 1, 31)
RECORDS = [
    {"sys_id": "1", "company": {"link": "x", "value": "c1"}, "note": "plain"},
    {"sys_id": "2", "company": {"link": "x", "value": None}},
    {"sys_id": "3", "company": {"link": "x"}},
    {"sys_id": "4", "company": "", "note": '{"value":"looks like one"}'},
    {"sys_id": "5", "company": None},
    {"sys_id": "6"},
]


def kinds(schema):
    return [(f.name, f.dataType) for f in schema.fields]


def records(spark, items=RECORDS):
    page = json.dumps({"result": [*items, {}, None]}, ensure_ascii=False)
    empty = [json.dumps({"result": []}), json.dumps({"status": "failure"})]
    return parse_envelope(spark.createDataFrame([(page,), *[(e,) for e in empty]], "page STRING"))


def test_null_and_empty_records_are_skipped(spark):
    assert records(spark).count() == len(RECORDS)


def test_reference_objects_become_their_value(spark):
    out = N.flatten_refs(records(spark), ["sys_id", "company", "note"], ["company"])
    got = {r["sys_id"]: (r["company"], r["dv_company"], r["note"]) for r in out.collect()}
    assert got == {
        "1": ("c1", "", "plain"),
        "2": (None, "", None),
        "3": ('{"link":"x"}', None, None),
        "4": ("", None, '{"value":"looks like one"}'),
        "5": (None, None, None),
        "6": (None, None, None),
    }


def test_fields_are_discovered_over_all_records(spark):
    seen = N.discover_fields(records(spark))
    assert seen == {"company": True, "note": False, "sys_id": False}
    out = N.flatten_refs(records(spark).select("record"))
    assert out.columns == ["company", "note", "sys_id", "dv_company"]


def test_flags(spark):
    values = [("true",), ("True",), ("1",), ("0",), ("",), (None,), ("false",)]
    df = spark.createDataFrame(values, "customer STRING")
    out = N.normalize_flags(df.withColumn("active", F.lit(True)))
    assert [tuple(r) for r in out.collect()] == [(1, 1), (0, 1), (1, 1), (0, 1), (0, 1), (0, 1), (0, 1)]
    assert "vendor" not in out.columns


def test_is_set_takes_any_flag_type(spark):
    df = spark.createDataFrame([("1", 1, True), ("false", 0, False), (None, None, None)], "a STRING, b INT, c BOOLEAN")
    got = [tuple(r) for r in df.select(*[F.coalesce(C.is_set(df, c), F.lit(False)) for c in df.columns]).collect()]
    assert got == [(True,) * 3, (False,) * 3, (False,) * 3]


def test_project_schema_fills_and_drops(spark):
    out = N.project_schema(spark.createDataFrame([("1", 5)], "sys_id STRING, other INT"), COMPANY)
    assert out.columns == COMPANY.fieldNames()
    assert out.first()["sys_id"] == "1" and out.first()["name"] is None


def test_derived_and_reference_columns(spark):
    df = spark.createDataFrame([("1", "", "x")], "sys_id STRING, dv_company STRING, dvx STRING")
    assert N.drop_derived(df).columns == ["sys_id", "dvx"]
    assert N.ensure_columns(df.select("sys_id")).columns == ["sys_id", "company", "resolved_by", "opened_by", "caller_id"]


text = st.one_of(st.none(), st.text(alphabet="a;=:-1\x1f\x00é", max_size=4))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(text, text), min_size=2, max_size=12))
def test_equal_hash_means_equal_row(spark, pairs):
    df = N.add_row_hash(spark.createDataFrame(pairs, "a STRING, b STRING"))
    got = df.collect()
    for x in got:
        for y in got:
            assert (x["etl_hash"] == y["etl_hash"]) == ((x["a"], x["b"]) == (y["a"], y["b"]))


def test_hash_ignores_load_and_update_times_only(spark):
    base = {"sys_id": "1", "sys_updated_by": "x", "sys_updated_on": "a", "sys_created_on": "a", "etl_updated_at": "a", "dv_x": ""}

    def digest(**change):
        return N.add_row_hash(spark.createDataFrame([{**base, **change}])).first()["etl_hash"]

    same = digest()
    assert digest(sys_updated_on="b", sys_created_on="b", etl_updated_at="b") == same
    assert digest(sys_updated_by="y") != same and digest(dv_x="z") != same


def test_typed_conform_applies_casts_and_defaults(spark):
    df = spark.createDataFrame([("1", "acme", "true", None, "x", "2024-01-02 03:04:05")],
                               "sys_id STRING, name STRING, customer STRING, vendor STRING, active STRING, sys_updated_on STRING")
    out = N.typed_conform(df, "company", AS_OF)
    assert kinds(out.schema) == kinds(typed_schema("company"))
    row = out.first()
    assert (row.customer, row.vendor, row.active) == (True, False, True)
    assert row.sys_updated_on == datetime(2024, 1, 2, 3, 4, 5) and row.etl_created_at == AS_OF


def test_every_typed_table_conforms_from_nothing_but_text(spark):
    for table, fields in TYPED_TABLES.items():
        schema = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
        out = N.typed_conform(spark.createDataFrame([tuple(None for _ in fields)], schema), table, AS_OF)
        assert kinds(out.schema) == kinds(typed_schema(table))
        assert out.count() == 1


def test_rejects_split(spark):
    df = spark.createDataFrame(
        [("1", "ok", "true"), (None, "no key", "1"), ("3", "x" * 256, "maybe"), ("4", None, None)],
        "sys_id STRING, name STRING, active STRING",
    )
    good, bad = N.split_rejects(df, "company")
    assert [r["sys_id"] for r in good.collect()] == ["1"]
    reasons = {r["sys_id"]: r["reject_reason"] for r in bad.collect()}
    assert reasons == {None: "sys_id:missing", "3": "name:too long,active:bad value", "4": "name:missing"}


def test_column_profile(spark):
    df = spark.createDataFrame([("1", "ab", None), ("22", None, None)], "sys_id STRING, dv_a STRING, n INT")
    assert rows(column_profile(df)) == [(1, "sys_id", "string", 2, 0, 2), (2, "dv_a", "string", 2, 1, 2), (3, "n", "int", 2, 2, None)]
    assert [r["column_name"] for r in column_profile(df, prefix="dv_").collect()] == ["dv_a"]
    assert column_profile(df, names=["nothing"]).count() == 0
