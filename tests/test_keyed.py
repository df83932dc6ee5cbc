"""Keyed tables: buckets, one read a merge, commits of several writers."""

import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from ticketlake.session import together
from ticketlake.sources.commits import CommitLog, Conflict
from ticketlake.sources.keyed import LOOSE, KeyedTable, fitting_buckets
from ticketlake.sources.tables import TableStore

SCHEMA = "sys_id STRING, v STRING, seq INT"


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "t"))


def frame(spark, values):
    return spark.createDataFrame([(k, v, n) for n, (k, v) in enumerate(values)], SCHEMA)


def test_one_of_two_claims_of_a_number_succeeds(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.latest() == (0, {})
    won = together({w: partial(CommitLog(spark, str(tmp_path / "log")).claim, 1, {"by": w}) for w in "abcdefgh"})
    assert sorted(won.values()) == [False] * 7 + [True]
    assert log.latest() == (1, {"by": next(w for w, ok in won.items() if ok)})
    assert not log.claim(1, {"by": "late"}) and log.read(1)["by"] != "late"


def test_random_batches_like_a_row_by_row_upsert(spark, table):
    rng, state, loose = random.Random(3), {}, []
    for n in range(5):
        batch = [(rng.choice([None, *map(str, range(25))]), str(rng.randint(0, 3))) for _ in range(40)]
        for k, v in batch:
            if k is None:
                loose.append((None, v))
        before = dict(state)
        state.update({k: v for k, v in batch if k is not None})
        last = {k: v for k, v in batch if k is not None}
        counts = table.merge(frame(spark, batch), ["seq"])
        assert counts == {
            "insert": len(set(last) - set(before)) + sum(k is None for k, _ in batch),
            "update": sum(before.get(k, v) != v for k, v in last.items()),
            "unchanged": sum(before.get(k) == v for k, v in last.items()),
        }
        assert rows(table.read()) == sorted([*loose, *state.items()], key=lambda r: (r[0] is not None, str(r[0]), r[1]))


def test_batch_and_table_are_read_once(spark, table):
    """Python counts the rows of the batch, the plan counts the scans of the table."""
    table.replace(frame(spark, [(str(k), "old") for k in range(200)]).drop("seq"), buckets=8)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(v):
        seen.add(1)
        return v

    batch = frame(spark, [(str(k), "new") for k in range(0, 300, 3)]).repartition(3).withColumn("v", counted("v"))
    scans = []
    scan = table._rows
    table._rows = lambda state, parts: scans.append(sorted(parts)) or scan(state, parts)
    counts = table.merge(batch, ["seq"])
    assert seen.value == 100 and counts == {"insert": 33, "update": 67, "unchanged": 0}
    assert len(scans) == 1 and len(scans[0]) == len(set(scans[0])) <= 8


def test_untouched_buckets_keep_their_files(spark, table):
    table.replace(frame(spark, [(str(k), "old") for k in range(400)]).drop("seq"), buckets=64)
    before = table.state()
    table.merge(frame(spark, [("5", "new"), ("6", "old"), ("new", "x")]), ["seq"])
    after = table.state()
    moved = {b for b in before.base if before.base[b] != after.base[b]}
    assert 1 <= len(moved) <= 2  # of "5" and "new"; the bucket of "6" has the same rows
    files = {r["file_path"] for r in table.rows(after, set(before.base) - moved).select("_metadata.file_path").distinct().collect()}
    assert files and all(before.base[b] in f for f in files for b in [int(f.split("_bucket=")[1].split("/")[0])])
    assert rows(table.read()) == sorted([(str(k), "new" if k == 5 else "old") for k in range(400)] + [("new", "x")])


def test_writers_in_different_buckets_both_commit_and_in_the_same_one_compares_again(spark, table):
    table.replace(frame(spark, [(str(k), "0") for k in range(100)]).drop("seq"), buckets=16)
    runs = {w: partial(table.merge, frame(spark, [(str(k), f"{w}") for k in range(i, 100, 4)] + [("all", w)]), ["seq"]) for i, w in enumerate("abcd")}
    counts = together(runs)
    got = dict(rows(table.read()))
    assert all(got[str(k)] == "abcd"[k % 4] for k in range(100)) and got["all"] in "abcd"
    assert sum(c["insert"] for c in counts.values()) == 1 and sum(c["update"] for c in counts.values()) == 103
    assert table.log.numbers() == [1, 2, 3, 4, 5]


def test_a_replacement_made_from_an_old_state_is_refused(spark, table):
    table.merge(frame(spark, [("a", "1")]), ["seq"])
    old = table.state()
    table.merge(frame(spark, [("b", "1")]), ["seq"])
    with pytest.raises(Conflict):
        table.replace(table.read(old), based_on=old)
    assert rows(table.read()) == [("a", "1"), ("b", "1")]


def test_new_columns_and_types(spark, table):
    table.merge(frame(spark, [("a", "1"), ("b", "2")]), ["seq"])
    wider = spark.createDataFrame([("b", 7, "w"), ("c", 8, None)], "sys_id STRING, v INT, w STRING")
    assert table.merge(wider) == {"insert": 1, "update": 1, "unchanged": 0}
    assert rows(table.read()) == [("a", "1", None), ("b", "7", "w"), ("c", "8", None)]
    assert table.merge(spark.createDataFrame([("b", "x")], "sys_id STRING, w STRING"))["update"] == 1
    assert rows(table.read()) == [("a", "1", None), ("b", "7", "x"), ("c", "8", None)]


def test_batches_carry_their_number_into_the_commit(spark, table):
    batch = frame(spark, [("a", "1"), (None, "loose")])
    for number in (0, 0, 1, 0):
        table.merge(batch, ["seq"], writer="w", number=number)
    assert rows(table.read()) == [(None, "loose"), (None, "loose"), ("a", "1")]
    table.merge(batch, ["seq"], writer="other", number=0)
    assert table.state().applied == {"w": 1, "other": 0}


def test_actions_of_a_merge(spark, table):
    table.merge(frame(spark, [("a", "1"), ("b", "2"), ("c", "3"), (None, "9")]), ["seq"])
    out = table.actions(frame(spark, [("a", "1"), ("b", "x"), ("d", "4"), ("d", "5"), (None, "8")]), ["seq"])
    assert rows(out) == [
        (None, "8", "insert"), (None, "9", "keep"), ("a", "1", "unchanged"), ("b", "x", "update"), ("c", "3", "keep"), ("d", "5", "insert")
    ]


def test_hot_key_of_a_batch_is_cut_before_buckets_meet(spark, table):
    table.replace(frame(spark, [("hot", "old")]).drop("seq"))
    batch = spark.range(0, 9000, 1, 6).select(F.lit("hot").alias("sys_id"), F.col("id").cast("string").alias("v"), F.col("id").alias("seq"))
    out = table.actions(batch, ["seq"])
    assert rows(out) == [("hot", "8999", "update")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan and "Join" not in plan


def test_empty_batches_and_tables(spark, table):
    none = frame(spark, [("a", "1")]).where("false")
    assert table.read() is None and table.state() is None
    assert table.merge(none, ["seq"]) == {"insert": 0, "update": 0, "unchanged": 0}
    assert table.read().collect() == [] and table.read().columns == ["sys_id", "v"]
    table.merge(frame(spark, [("a", "1")]), ["seq"])
    number = table.state().number
    table.merge(none, ["seq"])
    assert table.state().number == number and rows(table.read()) == [("a", "1")]


def test_buckets_grow_with_the_table(spark, table, monkeypatch):
    assert [fitting_buckets(n << 28) for n in (0, 4, 5, 100, 10**9)] == [4, 4, 8, 128, 1 << 15]
    table.merge(frame(spark, [("a", "1"), (None, "x")]), ["seq"])
    monkeypatch.setattr("ticketlake.sources.keyed.BUCKET_BYTES", 200)
    table.merge(frame(spark, [(str(k), "1" * 50) for k in range(500)]), ["seq"])
    assert table.state().buckets > 4 and table.read().count() == 502
    assert table.merge(frame(spark, [("7", "2")]), ["seq"]) == {"insert": 0, "update": 1, "unchanged": 0}
    assert len({k for k, _ in rows(table.read())}) == 502


def test_vacuum_keeps_what_newer_states_are_made_of(spark, table):
    for n in range(5):
        table.merge(frame(spark, [(str(k), f"{n}") for k in range(n, 40, 5)] + [(None, "x")]), ["seq"])
    content, first = rows(table.read()), table.state(1)
    assert LOOSE in {b for _, b in first.parts()} and table.vacuum(keep=2) > 0
    assert rows(table.read()) == content and len(table.log.numbers()) == 2
    assert table.read(table.state(4)).count() == 36
    kept = {n for n in table.data.children()}
    assert table.vacuum(keep=1) >= 0 and rows(table.read()) == content and set(table.data.children()) <= kept


def test_whole_tables_are_never_overwritten_and_updates_start_again(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    add = lambda w: store.update("t", lambda old: frame(spark, [(w, "1")]) if old is None else old.union(frame(spark, [(w, "1")])))
    together({w: partial(add, w) for w in "abcd"})
    assert sorted(r["sys_id"] for r in store.read("t").collect()) == list("abcd") and store.version("t") == 4
    store.publish("t", frame(spark, [("z", "1")]))
    assert store.version("t") == 5 and store.read("t").count() == 1
    assert store.vacuum("t", keep=1) == 4 and store.read("t").count() == 1
