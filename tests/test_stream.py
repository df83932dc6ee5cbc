from datetime import datetime, timedelta
from functools import partial

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from ticketlake.operators import sync
from ticketlake.operators.merge import merge_upsert
from ticketlake.session import together
from ticketlake.sources.keyed import KeyedTable
from ticketlake.sources.tables import TableStore
from ticketlake.streaming.incremental import apply_batch, incremental_stream

AS_OF = datetime(2024, 1, 31)
T0 = datetime(2024, 1, 1)
SCHEMA = "sys_id STRING, name STRING, sys_updated_on TIMESTAMP_NTZ, seq INT"
SHOWN = ["sys_id", "name", "sys_updated_on", "etl_hash"]
FILES = [
    [("a", "a1", T0 + timedelta(hours=1), 1), ("b", "b1", T0 + timedelta(hours=1), 2), ("b", "b2", T0 + timedelta(hours=1), 3)],
    [("a", "a1", T0 + timedelta(hours=2), 4), ("c", "c1", T0 + timedelta(hours=2), 5), ("z", "z1", T0 + timedelta(hours=2), 6)],
    [("a", "a2", T0 + timedelta(hours=3), 7), ("c", "c0", T0 + timedelta(minutes=1), 8), ("z", "z2", T0 + timedelta(hours=3), 9)],
]


@pytest.fixture
def store(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "tables"))
    base = spark.createDataFrame([("z", "z0", T0), ("y", "y0", T0)], "sys_id STRING, name STRING, sys_updated_on TIMESTAMP_NTZ")
    store.keyed("user").replace(sync.normalise_reference(base, "user", T0))
    return store


def expected(spark, store):
    """The batch form: newest version per id over everything, then one upsert."""
    everything = spark.createDataFrame([r for f in FILES for r in f], SCHEMA)
    _, changes = sync.incremental_sync(
        everything, store.current("user").withColumn("etl_updated_at", F.lit(T0).cast("timestamp_ntz")), "user", AS_OF, ["seq"]
    )
    return rows(merge_upsert(store.current("user"), changes.drop("change_type"), "sys_id").select(*SHOWN))


def written(store):
    """Keys of all rows that were added beside their buckets."""
    table = store.keyed("user")
    state = table.state()
    base = set(state.base.values())
    return sorted(r["sys_id"] for r in table.versions(state).collect() if r["_commit"] not in base)


def write(spark, folder, n):
    spark.createDataFrame(FILES[n], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


@pytest.mark.parametrize("late_by", [None, "1 hour"])
def test_stream_ends_where_the_batch_ends(spark, store, tmp_path, late_by):
    want = expected(spark, store)
    folder = str(tmp_path / "in")
    for n in range(len(FILES)):
        write(spark, folder, n)
        source = spark.readStream.schema(SCHEMA).parquet(folder)
        incremental_stream(
            source, store, "user", "user", str(tmp_path / "checkpoint"), AS_OF, ["seq"], late_by
        ).awaitTermination()
    assert rows(store.current("user").select(*SHOWN)) == want
    if late_by is None:  # an unchanged row is not written again, an older one never
        assert written(store) == ["a", "a", "b", "c", "z", "z"]
    store.keyed("user").compact()
    assert store.keyed("user").pending() == 0
    assert rows(store.current("user").select(*SHOWN)) == want


def test_many_small_batches_with_compaction(spark, store, tmp_path):
    want = expected(spark, store)
    folder = str(tmp_path / "in")
    for n in range(len(FILES)):
        write(spark, folder, n)
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    incremental_stream(
        source, store, "user", "user", str(tmp_path / "checkpoint"), lambda: AS_OF, ["seq"], compact_every=2
    ).awaitTermination()
    assert store.keyed("user").pending() <= 1
    assert rows(store.current("user").select(*SHOWN)) == want


def apply(spark, store, n, batch_id, writer="query"):
    apply_batch(spark.createDataFrame(FILES[n], SCHEMA), batch_id, writer, store.keyed("user"), "user", AS_OF, ["seq"])


def test_replayed_batch_changes_nothing(spark, store):
    apply(spark, store, 0, 0)
    apply(spark, store, 1, 1)
    once = rows(store.current("user"))
    apply(spark, store, 1, 1)
    assert rows(store.current("user")) == once
    store.keyed("user").compact()
    apply(spark, store, 1, 1)  # replayed after its changes became part of the base
    assert rows(store.current("user")) == once


def test_first_batch_may_create_the_table(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    apply(spark, store, 0, 0)
    assert rows(store.current("user").select("sys_id", "name")) == [("a", "a1"), ("b", "b2")]


def test_unfinished_versions_are_not_read(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.read("t") is None
    store.publish("t", spark.range(3))
    spark.range(9).write.parquet(str(tmp_path / "t" / "data" / "unfinished"))
    (tmp_path / "t" / "log" / ".half").write_text("{")
    assert store.version("t") == 1 and store.read("t").count() == 3
    old = store.read("t")
    store.publish("t", store.read("t").union(spark.range(1)))
    assert store.read("t").count() == 4 and old.count() == 3


def test_a_value_that_returns_is_kept_with_late_by(spark, store, tmp_path):
    versions = [("q", v, T0 + timedelta(minutes=m), m) for m, v in ((1, "A"), (2, "B"), (3, "A"))]
    nameless = [(None, "same", T0 + timedelta(minutes=5), 9)] * 2
    folder = str(tmp_path / "in")
    spark.createDataFrame(versions + nameless, SCHEMA).coalesce(1).write.parquet(folder)
    source = spark.readStream.schema(SCHEMA).parquet(folder)
    incremental_stream(source, store, "user", "user", str(tmp_path / "checkpoint"), AS_OF, ["seq"], "1 hour").awaitTermination()
    state = store.current("user")
    assert [r["name"] for r in state.where("sys_id = 'q'").collect()] == ["A"]
    assert state.where("name = 'same'").count() == 2


def test_two_checkpoints_on_one_table_lose_nothing(spark, store, tmp_path):
    """Both queries count their batches from 0."""
    for n, (name, seq) in enumerate((("first", 1), ("second", 2))):
        folder = str(tmp_path / f"in{n}")
        spark.createDataFrame([(name, name, T0 + timedelta(hours=n + 1), seq)], SCHEMA).write.parquet(folder)
        source = spark.readStream.schema(SCHEMA).parquet(folder)
        incremental_stream(source, store, "user", "user", str(tmp_path / f"checkpoint{n}"), AS_OF, ["seq"]).awaitTermination()
        store.keyed("user").compact()
    assert {r["sys_id"] for r in store.current("user").collect()} == {"y", "z", "first", "second"}
    assert sorted(store.keyed("user").state().applied.values()) == [0, 0]


def test_a_batch_reads_only_its_buckets(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    many = spark.range(500).select(F.col("id").cast("string").alias("sys_id"), F.lit("n").alias("name"), F.lit(T0).cast("timestamp_ntz").alias("sys_updated_on"))
    store.keyed("user").replace(sync.normalise_reference(many, "user", T0), buckets=64)
    read = []
    scan = KeyedTable._rows
    monkeypatch.setattr(KeyedTable, "_rows", lambda self, state, parts: read.append(set(parts)) or scan(self, state, parts))
    batch = spark.createDataFrame([("7", "new", T0 + timedelta(hours=1), 1), ("x", "x", T0, 2), (None, "no id", T0, 3)], SCHEMA)
    apply_batch(batch, 0, "query", store.keyed("user"), "user", AS_OF, ["seq"])
    [parts] = read
    assert len({b for _, b in parts}) <= 2  # of 64
    names = {r["sys_id"]: r["name"] for r in store.current("user").collect()}
    assert len(names) == 502 and names["7"] == "new" and names[None] == "no id"


def test_runs_and_streams_do_not_replace_each_other(spark, store):
    apply(spark, store, 0, 0)
    own = spark.createDataFrame([("run", "from a run"), ("b", "b of the run")], "sys_id STRING, name STRING")
    store.keyed("user").merge(own)
    apply(spark, store, 1, 1)
    apply(spark, store, 2, 0, writer="another query")
    apply(spark, store, 0, 0)  # replayed after a run rewrote its buckets
    names = {r["sys_id"]: r["name"] for r in store.current("user").collect()}
    assert names == {"run": "from a run", "b": "b of the run", "a": "a2", "c": "c1", "y": "y0", "z": "z2"}


def test_rows_without_an_id_are_not_inserted_again(spark, store):
    batch = spark.createDataFrame([(None, "nameless", T0, 1), ("n", "n1", T0, 2)], SCHEMA)
    own = spark.createDataFrame([("n", "run")], "sys_id STRING, name STRING")
    for _ in range(2):
        apply_batch(batch, 7, "query", store.keyed("user"), "user", AS_OF, ["seq"])
        store.keyed("user").merge(own)
        store.keyed("user").compact()
    assert store.current("user").where("name = 'nameless'").count() == 1


def test_batches_at_the_same_time_both_count(spark, store):
    """Two streams write at once, to the same buckets and to others; the slower one compares again."""
    def feed(writer):
        for n in range(4):
            batch = spark.createDataFrame([("shared", f"{writer}{n}", T0 + timedelta(hours=n), n), (f"{writer}{n}", "own", T0, 0)], SCHEMA)
            apply_batch(batch, n, writer, store.keyed("user"), "user", AS_OF, ["seq"])

    together({w: partial(feed, w) for w in ("p", "q", "r")})
    names = {r["sys_id"]: r["name"] for r in store.current("user").collect()}
    assert set(names) == {"y", "z", "shared"} | {f"{w}{n}" for w in "pqr" for n in range(4)}
    assert names["shared"][1] == "3"  # the newest, whoever wrote it
    assert store.keyed("user").state().applied == {"p": 3, "q": 3, "r": 3}
