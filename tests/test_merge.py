import random
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from ticketlake.functions import columns as C
from ticketlake.operators import dedup, merge

TARGET = [("a", "1", "keep"), ("b", "2", "keep"), ("c", "3", "keep"), (None, "9", "loose")]
SOURCE = [
    ("a", None, "new", 1),  # changed, NULL overwrites
    ("b", "2", None, 1),  # same value, but a new column
    ("d", "4", "x", 1), ("d", "5", "y", 3), ("d", "6", "z", 2),  # last one wins
    (None, "7", "n", 1), (None, "8", "n", 1),  # always inserted
]
EXPECTED = [
    (None, "7", None, "n"), (None, "8", None, "n"), (None, "9", "loose", None),
    ("a", None, "keep", "new"), ("b", "2", "keep", None), ("c", "3", "keep", None), ("d", "5", None, "y"),
]


def frames(spark):
    target = spark.createDataFrame(TARGET, "sys_id STRING, v STRING, only_target STRING")
    source = spark.createDataFrame(SOURCE, "sys_id STRING, v STRING, only_source STRING, seq INT")
    return target, source


@pytest.mark.parametrize("small", [True, False])
def test_merge_edges(spark, small):
    target, source = frames(spark)
    out = merge.merge_upsert(target, source, "sys_id", ["seq"], small_source=small)
    assert out.columns == ["sys_id", "v", "only_target", "only_source"]
    assert rows(out) == EXPECTED
    actions = {r["sys_id"]: r["merge_action"] for r in
               merge.merge_actions(target, source, "sys_id", ["seq"], small_source=small).where("sys_id IS NOT NULL").collect()}
    assert actions == {"a": "update", "b": "unchanged", "c": "keep", "d": "insert"}


@pytest.mark.parametrize("small", [True, False])
def test_merging_again_changes_nothing(spark, small):
    target, source = frames(spark)
    keyed = source.where("sys_id IS NOT NULL")
    once = merge.merge_upsert(target, keyed, "sys_id", ["seq"], small_source=small)
    twice = merge.merge_upsert(once, keyed, "sys_id", ["seq"], small_source=small)
    assert rows(once) == rows(twice)


@pytest.mark.parametrize("small", [True, False])
def test_empty_and_key_only_tables(spark, small):
    target, source = frames(spark)
    assert rows(merge.merge_upsert(target, source.limit(0), "sys_id", ["seq"], small_source=small).select(*target.columns)) == rows(target)
    keys = spark.createDataFrame([("a",), ("b",)], "k STRING")
    more = spark.createDataFrame([("b",), ("c",)], "k STRING")
    assert rows(merge.merge_upsert(keys, more, small_source=small)) == [("a",), ("b",), ("c",)]
    empty = merge.create_if_missing(spark, source.drop("seq"))
    assert merge.merge_upsert(empty, source, "sys_id", ["seq"], small_source=small).count() == 5


def test_random_batches_like_a_row_by_row_upsert(spark):
    rng = random.Random(7)
    state, target = {}, merge.create_if_missing(spark, spark.createDataFrame([], "sys_id STRING, v STRING"))
    for _ in range(3):
        batch = [(str(rng.randint(0, 30)), str(rng.randint(0, 5)), i) for i in range(60)]
        for key, value, _seq in batch:
            state[key] = value
        source = spark.createDataFrame(batch, "sys_id STRING, v STRING, seq INT")
        target = merge.merge_upsert(target, source, "sys_id", ["seq"], small_source=bool(rng.randint(0, 1)))
        assert dict(rows(target)) == state
        target = spark.createDataFrame(target.collect(), target.schema)


@pytest.mark.parametrize("small", [True, False])
def test_wide_hashed_batches_plan_quickly(spark, small):
    """48 columns under a hash of all of them: planning must not grow with every mix of names."""
    wide = spark.range(20).select(
        F.col("id").cast("string").alias("sys_id"), *[F.col("id").alias(f"c{i}") for i in range(47)], F.col("id").alias("seq")
    )
    hashed = wide.withColumn("etl_hash", C.row_hash(wide.columns))
    text = hashed.drop("seq").where("sys_id < 15").select(*[F.col(c).cast("string") for c in hashed.columns if c != "seq"])
    start = time.time()
    actions = merge.merge_actions(text, hashed, order=["seq"], small_source=small)
    assert rows(actions.groupBy("merge_action").count()) == [("insert", 5), ("unchanged", 15)]
    batch = merge.source_actions(text, hashed, order=["seq"])
    assert rows(batch.groupBy("merge_action").count()) == [("insert", 5), ("unchanged", 15)]
    assert time.time() - start < 90


def test_source_actions_and_metrics(spark):
    target, source = frames(spark)
    source = source.drop("only_source")
    got = sorted((r["sys_id"] or "", r["v"], r["merge_action"]) for r in merge.source_actions(target, source, "sys_id", ["seq"]).collect())
    assert got == [("", "7", "insert"), ("", "8", "insert"), ("a", None, "update"), ("b", "2", "unchanged"), ("d", "5", "insert")]
    metrics = merge.merge_metrics(merge.merge_actions(target, source, "sys_id", ["seq"])).first().asDict()
    assert metrics == {"records_written": 4, "inserted": 3, "updated": 1, "unchanged": 1, "untouched": 2}


def test_keep_first_treats_null_as_one_key(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 5), (None, 4)], "k STRING, n INT")
    assert rows(dedup.keep_first(df, "k", ["n"])) == [(None, 4), ("a", 1)]
    assert rows(dedup.last_wins(df, "k", ["n"])) == [(None, 4), (None, 5), ("a", 2)]


def test_hot_key_is_cut_before_the_shuffle(spark):
    """A third of the rows share a key; each task sends one of them."""
    df = spark.range(0, 9000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    out = dedup.last_wins(df, "k", ["id"])
    assert out.count() == 6001 and out.where("k = 'hot'").first()["id"] == 8997
    plan = out._jdf.queryExecution().executedPlan().toString()
    partial, final = plan.index("Partial"), plan.index("Final")
    assert "WindowGroupLimit" in plan and final < partial  # the partial limit runs below the exchange
