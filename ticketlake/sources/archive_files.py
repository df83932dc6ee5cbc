"""Archived extractions: gzip JSON files, one record per line.

``<root>/<save>/table=<name>/*.txt.gz`` is one entry; a save of several days at
once lies in ``<root>/<save>/day=<day>/table=<name>``, one entry a day.  Files
are as large as a shuffle partition should be (AQE rebalances records by their
bytes), whatever the number of records.  An entry counts once its row is in the
entry list; files of an unfinished save are never looked at.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.functions.periods import to_day
from ticketlake.operators.archive import entry_sizes, record_json
from ticketlake.session import scratch_dir


def _records(tables: dict[str, DataFrame], days: dict[str, str] | None) -> DataFrame:
    """(day, table, record) of all tables; the day is null unless ``days`` names a time column of each."""
    out = None
    for name, df in tables.items():
        day = F.substring(F.col(days[name]).cast("string"), 1, 10) if days else F.lit(None).cast("string")
        # the day travels beside the record, not in it
        rows = record_json(df, keep={"day": day}).select("day", F.lit(name).alias("table"), "record")
        out = rows if out is None else out.unionByName(rows)
    return out


def write_files(
    spark: SparkSession, tables: dict[str, DataFrame], path: str, days: dict[str, str] | None = None
) -> DataFrame:
    """Write every table's records in one job; the JVM compresses while it writes.

    Returns the manifest: (day, table, record_count, json_bytes, files,
    compressed_bytes), one row per folder.  It is stored, so it tells what was
    written, whatever becomes of the tables or of other days' folders.
    """
    records = _records(tables, days)
    parts = ["day", "table"] if days else ["table"]
    written = records if days else records.drop("day")
    written.hint("rebalance", *[F.col(p) for p in parts]).write.mode("overwrite").option("compression", "gzip").option(
        "zlib.compress.level", "BEST_COMPRESSION"
    ).partitionBy(*parts).text(path)
    counts = records.groupBy("day", "table").agg(
        F.count(F.lit(1)).alias("record_count"), F.sum(F.octet_length("record")).alias("json_bytes")
    )
    empty = spark.createDataFrame([(name,) for name in tables], "table STRING").select(
        F.lit(None).cast("string").alias("day"), "table", F.lit(0).alias("record_count"), F.lit(0).alias("json_bytes")
    )
    if not days:  # a table without records is part of the entry, too
        counts = counts.unionByName(empty.join(counts, "table", "left_anti"))
    sizes = file_sizes(spark, path, by_day=True).withColumnsRenamed({"day": "_day", "table": "_table"})
    same = F.col("day").eqNullSafe(F.col("_day")) & (F.col("table") == F.col("_table"))
    manifest, held = counts.join(sizes, same, "left").drop("_day", "_table"), scratch_dir(spark, "manifest")
    manifest.write.parquet(held)
    return spark.read.schema(manifest.schema).parquet(held)


def read_files(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """Archived records of one entry as (table, record); no other entry is listed, and one table alone if it is named."""
    if table is not None:
        rows = spark.read.schema("value STRING").text(f"{path}/table={table}").withColumn("table", F.lit(table))
    else:
        rows = spark.read.schema("value STRING, table STRING").text(path)
    return rows.select("table", F.col("value").alias("record"))


def file_sizes(spark: SparkSession, path: str, by_day: bool = False) -> DataFrame:
    """Files and compressed bytes per table (and day), from the file listing alone."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.gz")
        .option("recursiveFileLookup", True)
        .load(path)
    )
    part = lambda name: F.nullif(F.regexp_extract("path", f"/{name}=([^/]+)/", 1), F.lit(""))
    keys = [part("day").alias("day")] * by_day + [part("table").alias("table")]
    return files.groupBy(*keys).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("compressed_bytes"))


def _entries(
    manifest: DataFrame, entry_id: Column, start: Column, end: Column, extraction_type: str, as_of: datetime,
    api_requests: int, duration_seconds: float | None,
) -> DataFrame:
    total = manifest.groupBy("day").agg(
        F.sum("record_count").alias("record_count"),
        F.sum("json_bytes").alias("json_bytes"),
        F.sum("compressed_bytes").alias("compressed_bytes"),
    )
    return total.select(
        entry_id.alias("id"),
        F.lit(to_day(as_of)).cast("date").alias("data_extraction"),
        F.lit(extraction_type).alias("extraction_type"),
        start.cast("date").alias("start_date"),
        end.cast("date").alias("end_date"),
        F.col("record_count"),
        *[c.alias(n) for n, c in entry_sizes(F.col("json_bytes"), F.col("compressed_bytes")).items()],
        F.lit(duration_seconds).cast("decimal(8,2)").alias("extraction_duration_seconds"),
        F.lit(api_requests).alias("api_requests_count"),
        F.lit(as_of).cast("timestamp_ntz").alias("created_at"),
    )


def save_entry(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    root: str,
    extraction_type: str,
    start=None,
    end=None,
    *,
    as_of: datetime,
    api_requests: int = 0,
    duration_seconds: float | None = None,
    entry_id: str | None = None,
) -> DataFrame:
    """Write one extraction and return its entry row (not yet listed anywhere)."""
    entry_id = entry_id or uuid.uuid4().hex
    day = lambda v: F.lit(to_day(v) if v else None)
    manifest = write_files(spark, tables, f"{root}/{entry_id}")
    return _entries(manifest, F.lit(entry_id), day(start), day(end), extraction_type, as_of, api_requests, duration_seconds)


def save_days(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    root: str,
    days: dict[str, str],
    only_with: str,
    *,
    as_of: datetime,
    extraction_type: str = "daily",
) -> DataFrame:
    """Write the records of many days in one job and return an entry row for each day that has any of ``only_with``.

    ``days`` names the time column of each table.  Other days' records lie in
    files that no entry names.
    """
    save = uuid.uuid4().hex
    manifest = write_files(spark, tables, f"{root}/{save}", days)
    wanted = manifest.where(F.col("table") == only_with).select("day")
    day = F.col("day")
    entry_id = F.concat(F.lit(f"{save}/day="), day)
    return _entries(manifest.join(wanted, "day", "left_semi"), entry_id, day, day, extraction_type, as_of, 0, None)


def load_latest(
    spark: SparkSession, entries: DataFrame, root: str, day, extraction_type: str = "daily", table: str | None = None
) -> DataFrame | None:
    """Records of the newest entry for (extraction date, type), or None."""
    found = (
        entries.where(
            (F.col("data_extraction") == F.lit(to_day(day)).cast("date"))
            & (F.col("extraction_type") == extraction_type)
        )
        .orderBy(F.desc("created_at"), F.desc("id"))
        .select("id")
        .first()
    )
    return None if found is None else read_files(spark, f"{root}/{found['id']}", table)
