"""Schemas of stored tables: added columns, wider types, text that becomes typed."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from ticketlake.operators.normalize import declared_schema
from ticketlake.plans import catalog, loads
from ticketlake.schemas import TYPED_STORAGE, typed_schema
from ticketlake.sources.evolution import SchemaConflict, declared_field, evolved, widens
from ticketlake.sources.keyed import KeyedTable

AS_OF = datetime(2001, 8, 2, 6)
pytestmark = pytest.mark.usefixtures("spark")  # types are read from text


def schema(**types):
    return T._parse_datatype_string(", ".join(f"{c} {t}" for c, t in types.items()))


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "t"))


@pytest.mark.parametrize(
    "old,new,ok",
    [
        ("int", "long", True), ("long", "int", False), ("byte", "int", True), ("float", "double", True), ("int", "double", True),
        ("long", "double", False), ("date", "timestamp_ntz", True), ("decimal(5,2)", "decimal(9,4)", True),
        ("decimal(5,2)", "decimal(6,4)", False), ("decimal(5,2)", "decimal(5,2)", False), ("boolean", "int", False),
    ],
)
def test_which_types_are_wider(old, new, ok):
    assert widens(schema(a=old)["a"].dataType, schema(a=new)["a"].dataType) is ok


def test_rules_of_a_schema_change():
    stored = schema(sys_id="string", n="long", t="string")
    assert evolved(stored, schema(n="int", x="date")) == (schema(sys_id="string", n="long", t="string", x="date"), [])
    assert evolved(stored, schema(t="boolean"))[1] == ["t"]
    with pytest.raises(SchemaConflict, match="column n"):
        evolved(stored, schema(n="boolean"))


def test_added_and_wider_columns_touch_no_file(spark, table):
    old = spark.createDataFrame(
        [("a", 1, date(2024, 1, 2), Decimal("1.25"), 0.5, 7), (None, 2, None, None, None, None)],
        "sys_id STRING, n INT, d DATE, p DECIMAL(5,2), f FLOAT, i INT",
    )
    table.replace(old, buckets=4)
    before = table.state()
    wider = schema(n="long", d="timestamp_ntz", p="decimal(9,4)", f="double", i="double")
    added = [declared_field("ok", T.BooleanType(), "true"), declared_field("s", T.StringType(), "it's"), declared_field("z", T.DateType())]
    after = table.evolve(T.StructType([*wider, *added]))
    assert (after.base, after.loose, after.version) == (before.base, before.loose, before.version + 1)
    assert [f.dataType for f in table.read().schema] == [
        T.StringType(), *(f.dataType for f in wider), T.BooleanType(), T.StringType(), T.DateType()
    ]
    assert rows(table.read()) == [
        (None, 2, None, None, None, None, True, "it's", None),
        ("a", 1, datetime(2024, 1, 2), Decimal("1.2500"), 0.5, 7.0, True, "it's", None),
    ]
    assert table.evolve(T.StructType([*wider, *added])).number == after.number  # nothing left to do


def test_defaults_belong_to_new_rows_and_values_stay(spark, table):
    declared = T.StructType([declared_field("sys_id", T.StringType()), declared_field("ok", T.BooleanType(), "true"), declared_field("v", T.LongType())])
    first = spark.createDataFrame([("a", False, 1), ("b", None, 2)], "sys_id STRING, ok BOOLEAN, v LONG")
    table.merge(first, declared=declared)
    counts = table.merge(spark.createDataFrame([("a", 5), ("b", 2), ("c", 3)], "sys_id STRING, v INT"), declared=declared)
    assert counts == {"insert": 1, "update": 1, "unchanged": 1}
    assert rows(table.read()) == [("a", False, 5), ("b", None, 2), ("c", True, 3)]
    table.merge(spark.createDataFrame([("d", 4)], "sys_id STRING, w INT"), declared=T.StructType([*declared, declared_field("k", T.IntegerType(), "9")]))
    assert rows(table.read().select("sys_id", "ok", "v", "k", "w")) == [
        ("a", False, 5, 9, None), ("b", None, 2, 9, None), ("c", True, 3, 9, None), ("d", True, None, 9, 4)
    ]


def test_text_becomes_typed_only_if_every_value_fits(spark, table):
    table.replace(spark.createDataFrame([("a", "1", "2024-01-02 03:04:05"), ("b", "false", None)], "sys_id STRING, ok STRING, at STRING"))
    before = table.state()
    after = table.evolve(schema(ok="boolean", at="timestamp_ntz"))
    assert rows(table.read()) == [("a", True, datetime(2024, 1, 2, 3, 4, 5)), ("b", False, None)]
    assert after.version == before.version + 1 and rows(table.read(before)) == [("a", "1", "2024-01-02 03:04:05"), ("b", "false", None)]
    table.replace(spark.createDataFrame([("a", "1"), ("b", "perhaps")], "sys_id STRING, ok STRING"))
    kept = table.state()
    with pytest.raises(SchemaConflict, match="'ok': 1"):
        table.evolve(schema(ok="boolean"))
    assert table.state() == kept and len(table.data.children()) == len({c for n in table.log.numbers() for c, _ in table.state(n).parts()})


def test_changes_beside_a_bucket_follow_the_schema(spark, table):
    table.replace(spark.createDataFrame([("a", 1), ("b", 2)], "sys_id STRING, n INT"), buckets=4)
    table.add_changes(lambda _: spark.createDataFrame([("a", 10)], "sys_id STRING, n INT"), range(4), ["sys_id"], "w", 0, 4)
    table.evolve(T.StructType([declared_field("n", T.LongType()), declared_field("ok", T.BooleanType(), "true")]))
    big = 1 << 40
    table.add_changes(lambda _: spark.createDataFrame([("b", big, False)], "sys_id STRING, n LONG, ok BOOLEAN"), range(4), ["sys_id"], "w", 1, 4)
    want = [("a", 10, True), ("b", big, False)]
    assert rows(table.read()) == want
    table.compact()
    assert rows(table.read()) == want


def test_runs_store_users_and_companies_typed(spark, data, tmp_path):
    from ticketlake_queries.loads import resources

    given = {k: v for k, v in resources(data).items() if k in TYPED_STORAGE}
    run = loads.Run(spark, str(tmp_path), AS_OF, order=["seq1", "seq2", "seq3"])
    loads.load_reference(run, given)
    for name in TYPED_STORAGE:
        stored, wanted = run.table(name), typed_schema(name)
        assert {f.name: f.dataType for f in stored.schema if f.name in wanted.names} == {f.name: f.dataType for f in wanted}
        assert stored.where("active IS NULL OR etl_created_at IS NULL").count() == 0
        assert stored.where(F.col("active")).count() == given[name].where("active = 1").count()
    again = loads.load_reference(loads.Run(spark, str(tmp_path), AS_OF, order=run.order), given)
    assert all(m["insert"] == m["update"] == 0 < m["unchanged"] for m in again.merged.values())
    catalog.register_views(run)
    assert spark.table("user_account").schema["sys_updated_on"].dataType == T.TimestampNTZType()
    assert spark.sql("SELECT * FROM companies_with_stats WHERE active = 1").count() > 0


def test_a_table_stored_as_text_is_taken_over(spark, data, tmp_path):
    run = loads.Run(spark, str(tmp_path), AS_OF)
    text = data.company.drop("etl_updated_at")
    run.keyed("company").replace(text.select(*[F.col(c).cast("string").alias(c) for c in text.columns]))
    loads.load_reference(run, {"company": text.where("active = 1").limit(3)})
    stored = run.table("company")
    assert stored.schema["active"].dataType == T.BooleanType() and "etl_hash" in stored.columns
    assert stored.count() == text.count() and set(declared_schema("company", AS_OF).names) <= set(stored.columns)
