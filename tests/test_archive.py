import gzip
import json
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from ticketlake.operators import archive as A
from ticketlake.operators import storage as S
from ticketlake.sources import archive_files as AF

AS_OF = datetime(2024, 1, 31, 12)


def ratios(spark, values):
    items = [(i, datetime(2024, 1, 1) + timedelta(seconds=i), v) for i, v in enumerate(values)]
    random.Random(3).shuffle(items)
    return spark.createDataFrame(items, "id LONG, created_at TIMESTAMP_NTZ, compression_ratio DOUBLE")


def fold(values):
    avg = 0.0
    for v in values:
        if v is not None:
            avg = v if avg == 0 else (avg + v) / 2
    return avg


@pytest.mark.parametrize(
    "values",
    [
        [10, 20, 40],
        [0, 0, 30, 10],
        [55],
        [None, 12, None, 4],
        [10, -10, 7, 3],  # the fold meets exactly zero and starts again
        [50] + [0] * 30 + [8],
        [random.Random(1).uniform(-20, 95) for _ in range(3000)],  # longer than the tail
        [90] + [0] * 1095 + [8],  # zeros fill the tail, but not quite to underflow
        [0] * 1500 + [8],
        [90] + [0] * 1500 + [8],
        [99] + [0] * 1078 + [80] + [10] * 21,  # many zeros, and the average is not yet nothing
        [99] + [0] * 1100 + [80] + [10] * 21,
        [5] + [0] * 899 + [0] * 100 + [7, -7, 3.5, 2, -4.25, 0, 9] + [1.5] * 80,
    ],
)
def test_running_ratio_is_the_fold_over_all_saves(spark, values):
    values = [None if v is None else float(v) for v in values]
    got = A.running_ratio(ratios(spark, values)).first()[0]
    assert got == pytest.approx(fold(values), rel=1e-15, abs=0)


def test_running_ratio_of_nothing(spark):
    assert A.running_ratio(ratios(spark, [None])).first()[0] == 0


def test_sizes(spark):
    df = spark.createDataFrame([(2048, 512), (1024, 1024), (1024, 2048), (0, 20), (1024, 0)], "raw LONG, gz LONG")
    sizes = A.entry_sizes(F.col("raw"), F.col("gz"))
    got = [tuple(None if v is None else float(v) for v in r) for r in df.select(*sizes.values()).collect()]
    assert got == [(2, 0.5, 75), (1, 1, None), (1, 2, -100), (0, 0.02, None), (1, None, 100)]
    none = A.entry_sizes(F.col("raw"), None)
    assert tuple(df.select(*none.values()).first())[1:] == (None, None)


def entries(spark):
    d = date(2024, 1, 30)
    return spark.createDataFrame(
        [
            ("1", d, "daily", d, d, 1), ("2", d, "backlog", None, None, 2), ("3", d, "range", d, date(2024, 1, 31), 3),
            ("4", date(2024, 1, 31), "daily", None, None, 4), ("5", d, None, d, d, 5),
        ],
        "id STRING, data_extraction DATE, extraction_type STRING, start_date DATE, end_date DATE, record_count INT",
    )


@pytest.mark.parametrize(
    "kind,window,gone",
    [
        ("daily", ("2024-01-30", "2024-01-30"), {"1"}),
        ("range", ("2024-01-30", "2024-01-31"), {"3"}),
        ("backlog", (None, None), {"2"}),
        ("daily", (None, None), {"4"}),
        ("daily", ("2024-01-30", None), {"4"}),
        ("range", ("2024-01-29", "2024-01-31"), set()),
    ],
)
def test_replace_slice(spark, kind, window, gone):
    new = entries(spark).limit(1).withColumn("id", F.lit("new"))
    out = A.replace_slice(entries(spark), new, kind, *window, as_of=AS_OF)
    assert {r["id"] for r in out.collect()} == ({"1", "2", "3", "4", "5"} - gone) | {"new"}


def test_record_json_is_compact_unescaped_and_without_nulls(spark):
    df = spark.createDataFrame(
        [("é \"q\"\n", None, datetime(2024, 1, 1, 0, 0, 7, 500), datetime(2024, 1, 1), date(2024, 2, 3))],
        "a STRING, b STRING, t TIMESTAMP_NTZ, u TIMESTAMP_NTZ, d DATE",
    )
    want = {"a": 'é "q"\n', "t": "2024-01-01T00:00:07.000500", "u": "2024-01-01T00:00:00", "d": "2024-02-03"}
    assert A.record_json(df).first()[0] == json.dumps(want, separators=(",", ":"), ensure_ascii=False)


def test_archive_round_trip_keeps_whole_texts(spark, data, tmp_path):
    documents, talks = data.table("documents"), data.table("conversations")
    root = str(tmp_path)
    entry = AF.save_entry(spark, {"documents": documents, "conversations": talks}, root, "daily", as_of=AS_OF, entry_id="e1")
    row = entry.first()
    assert row["record_count"] == documents.count() + talks.count()
    raw = sum(len(r[0].encode()) for r in A.record_json(documents).union(A.record_json(talks)).collect())
    assert float(row["json_size_kb"]) == pytest.approx(raw / 1024, abs=0.006)
    packed = sum(f.stat().st_size for f in tmp_path.rglob("*.gz"))
    assert float(row["compressed_size_kb"]) == pytest.approx(packed / 1024, abs=0.006)
    assert float(row["compression_ratio"]) == pytest.approx((1 - packed / raw) * 100, abs=0.006)
    back = AF.load_latest(spark, entry, root, AS_OF).where("table = 'documents'")
    back = back.select(F.from_json("record", documents.schema).alias("r")).select("r.*")
    assert rows(back) == rows(documents)
    assert AF.load_latest(spark, entry, root, "2024-01-30") is None


def test_archive_files_are_sized_by_bytes_and_listed(spark, tmp_path):
    """Many records in one small table are one file, few large ones are split."""
    wide = spark.range(0, 400, 1, 4).select("id", F.concat_ws("", F.transform(F.sequence(F.lit(0), F.lit(60)), lambda k: F.md5((F.col("id") * 99 + k).cast("string")))).alias("t"))
    narrow = spark.range(0, 30_000, 1, 1)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        manifest = AF.write_files(spark, {"wide": wide, "narrow": narrow, "none": narrow.limit(0)}, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    found = {r["table"]: r.asDict() for r in manifest}
    assert {t: r["record_count"] for t, r in found.items()} == {"wide": 400, "narrow": 30_000, "none": 0}
    assert found["wide"]["files"] >= 3 and found["narrow"]["files"] <= 3
    for t in ("wide", "narrow"):
        files = list((tmp_path / f"table={t}").glob("*.gz"))
        assert len(files) == found[t]["files"] and sum(f.stat().st_size for f in files) == found[t]["compressed_bytes"]
        assert sum(len(gzip.open(f).read().splitlines()) for f in files) == found[t]["record_count"]


def test_days_are_saved_in_one_write_and_one_is_read_alone(spark, tmp_path, monkeypatch):
    a = spark.createDataFrame([(k, f"2024-01-0{1 + k % 3} 10:00:00") for k in range(30)], "sys_id INT, opened_at STRING")
    b = spark.createDataFrame([(7, datetime(2024, 1, 2, 5)), (8, datetime(2024, 1, 9))], "sys_id INT, made TIMESTAMP_NTZ")
    entries = AF.save_days(spark, {"a": a, "b": b}, str(tmp_path), {"a": "opened_at", "b": "made"}, "a", as_of=AS_OF).orderBy("start_date")
    got = [(str(r["start_date"]), str(r["end_date"]), r["extraction_type"], r["record_count"]) for r in entries.collect()]
    assert got == [(d, d, "daily", n) for d, n in (("2024-01-01", 10), ("2024-01-02", 11), ("2024-01-03", 10))]
    second = entries.collect()[1]["id"]
    for folder in tmp_path.glob("*/day=2024-01-01"):  # the rest is not looked at
        folder.chmod(0)
    records = AF.read_files(spark, f"{tmp_path}/{second}")
    assert sorted((r["table"], json.loads(r["record"])["sys_id"]) for r in records.collect())[-1] == ("b", 7)
    assert AF.read_files(spark, f"{tmp_path}/{second}", "b").collect()[0]["record"] == '{"sys_id":7,"made":"2024-01-02T05:00:00"}'
    again = AF.save_days(spark, {"a": a.where("sys_id < 2")}, str(tmp_path / "2"), {"a": "opened_at"}, "a", as_of=AS_OF)
    listed = A.replace_windows(entries, again)
    assert sorted((str(r["start_date"]), r["record_count"]) for r in listed.collect()) == [("2024-01-01", 1), ("2024-01-02", 1), ("2024-01-03", 10)]


def test_entry_rows_tell_what_was_written(spark, tmp_path):
    spark.range(6).selectExpr("id", "concat('2024-01-0', 1 + id % 2) AS made").write.parquet(str(tmp_path / "source"))
    source = spark.read.parquet(str(tmp_path / "source"))
    entries = AF.save_days(spark, {"a": source}, str(tmp_path / "saved"), {"a": "made"}, "a", as_of=AS_OF)
    for file in [*tmp_path.glob("source/*.parquet"), *tmp_path.glob("saved/*/day=2024-01-01/*/*.gz")]:
        file.unlink()  # neither the table nor a day's files are read again
    assert sorted((str(r["start_date"]), r["record_count"]) for r in entries.collect()) == [("2024-01-01", 3), ("2024-01-02", 3)]


def test_batch_metadata_leaves_empty_tables_out_of_the_map(spark):
    got = A.batch_metadata({"b": spark.range(2), "a": spark.range(3), "z": spark.range(0)}).first()
    assert (got["table_count"], got["total_records"], got["records_by_table"]) == (3, 5, '{"a":3,"b":2}')


def saved(spark, json_kb, packed_kb, ratio=None):
    return spark.createDataFrame(
        [("e", date(2024, 1, 30), "daily", 10, json_kb, packed_kb, ratio, AS_OF)],
        "id STRING, data_extraction DATE, extraction_type STRING, record_count INT, json_size_kb DOUBLE, "
        "compressed_size_kb DOUBLE, compression_ratio DOUBLE, created_at TIMESTAMP_NTZ",
    )


@pytest.mark.parametrize(
    "packed,code",
    [(40.0, "archive"), (50.0, "historic"), (80.0, "trade-off"), (100.0, "similar"), (119.0, "similar"), (120.0, "tables"),
     (0.0, "insufficient"), (None, "insufficient")],
)
def test_recommendation_bounds_are_strict(spark, packed, code):
    sizes = spark.createDataFrame([("t", 4, 100.0)], "table_name STRING, record_count LONG, size_kb DOUBLE")
    report = S.project(S.recommend(S.efficiency(sizes, saved(spark, 200.0, packed)))).first()
    assert report["recommendation_code"] == code
    if code == "archive":
        assert float(report["space_saved_percent"]) == 60 and float(report["json_vs_normalized_ratio"]) == 0.4
        assert report["annual_savings_mb"] == pytest.approx(60 / 1024 * 12)
        assert report["five_year_savings_gb"] == pytest.approx(60 / 1024 * 12 * 5 / 1024)
    if code in ("similar", "tables", "insufficient"):
        assert report["annual_savings_mb"] is None


def test_report_of_nothing(spark):
    sizes = S.table_sizes({"a": spark.range(0), "b": None})
    assert [(r["table_name"], r["record_count"], float(r["size_kb"])) for r in sizes.collect()] == [("a", 0, 0), ("b", 0, 0)]
    report = S.efficiency(sizes, saved(spark, 1.0, 1.0).limit(0)).first()
    assert report["json_records"] == 0 and float(report["json_bytes_per_record"]) == 0
    assert float(report["space_saved_percent"]) == 0


def test_table_sizes_count_utf8_bytes(spark):
    df = spark.createDataFrame([("é" * 1024, None), ("", "x" * 1024)], "a STRING, b STRING")
    assert float(S.table_sizes({"t": df}).first()["size_kb"]) == 3
