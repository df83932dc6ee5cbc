"""Stored tables: keyed ones (``keyed``), whole ones, and logs that only grow.

A whole table is replaced by a new state, never rewritten in place.  States lie
in ``<root>/<table>/data/<name>``; a commit log tells which one counts, and two
writers cannot claim the same version.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.schemas import TYPED_TABLES
from ticketlake.session import scratch_dir
from ticketlake.sources.commits import ATTEMPTS, CommitLog, Conflict, Folder
from ticketlake.sources.evolution import widens
from ticketlake.sources.keyed import KeyedTable


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self, table: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/{table}/log")

    def keyed(self, table: str, key: str = "sys_id", sort_by: str | None = None) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/{table}", key, sort_by)

    def current(self, table: str) -> DataFrame | None:
        """A table as of now, of either kind; None if there is none."""
        _, content = self._log(table).latest()
        return self.keyed(table).read() if "buckets" in content else self.read(table)

    # -- whole tables -----------------------------------------------------------

    def version(self, table: str) -> int | None:
        """Number of the current state, None if there is no table yet."""
        return self._log(table).latest()[0] or None

    def exists(self, table: str) -> bool:
        return self.version(table) is not None

    def _state(self, table: str, content: dict) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.root}/{table}/data/{content['data']}") if content else None

    def read(self, table: str) -> DataFrame | None:
        return self._state(table, self._log(table).latest()[1])

    def _write(self, table: str, df: DataFrame) -> str:
        name = uuid.uuid4().hex
        df.write.parquet(f"{self.root}/{table}/data/{name}")
        return name

    def publish(self, table: str, df: DataFrame) -> DataFrame:
        """Replace whatever is there, and return the new state as stored.  Readers of the old one are not disturbed."""
        log, content = self._log(table), {"data": self._write(table, df)}
        for _ in range(ATTEMPTS):
            if log.claim(log.latest()[0] + 1, content):
                return self._state(table, content)
        raise Conflict(f"{table} is replaced too often")

    def update(self, table: str, make: Callable[[DataFrame | None], DataFrame]) -> DataFrame:
        """A new state made from the current one, and made again if another writer was faster."""
        log = self._log(table)
        for _ in range(ATTEMPTS):
            number, content = log.latest()
            made = {"data": self._write(table, make(self._state(table, content)))}
            if log.claim(number + 1, made):
                return self._state(table, made)
            Folder(self.spark, f"{self.root}/{table}/data").delete(made["data"])
        raise Conflict(f"{table} is updated too often")

    def vacuum(self, table: str, keep: int = 10) -> int:
        """Remove all but the newest states; returns how many were removed."""
        log, data = self._log(table), Folder(self.spark, f"{self.root}/{table}/data")
        if "buckets" in log.latest()[1]:
            return self.keyed(table).vacuum(keep)
        old = log.numbers()[:-keep]
        for number in old:
            data.delete(log.read(number)["data"])
            log.forget(number)
        return len(old)

    # -- logs -------------------------------------------------------------------

    def append(self, table: str, df: DataFrame, month_of: str | None = None) -> None:
        """Add rows to a log; by the month of a timestamp column if one is named."""
        if month_of is None:
            df.write.mode("append").parquet(f"{self.root}/{table}/rows")
        else:
            month = F.coalesce(F.date_format(month_of, "yyyy-MM"), F.lit("none"))
            df.withColumn("_month", month).write.mode("append").partitionBy("_month").parquet(f"{self.root}/{table}/rows")

    def _appended(self, table: str) -> DataFrame:
        """All rows of a log.  A column that was narrower when some were written has its declared type in all."""
        path = f"{self.root}/{table}/rows"
        rows = self.spark.read.parquet(path)
        declared = {f.name: f.dtype for f in TYPED_TABLES.get(table, [])}
        wider = {f.name: declared[f.name] for f in rows.schema if f.name in declared and widens(f.dataType, declared[f.name])}
        if not wider:
            return rows
        fields = [T.StructField(f.name, wider.get(f.name, f.dataType)) for f in rows.schema]
        return self.spark.read.schema(T.StructType(fields)).parquet(path)

    def read_appended(self, table: str) -> DataFrame | None:
        folder = Folder(self.spark, f"{self.root}/{table}/rows")
        return self._appended(table).drop("_month") if folder.children() else None

    def cut(self, table: str, column: str, before: datetime) -> int:
        """Remove the rows of a log by month that are older than a time; returns how many.

        Whole months go as folders.  The month of the cutoff alone is read, and
        its folder replaced by what stays (dynamic partition overwrite).
        """
        folder = Folder(self.spark, f"{self.root}/{table}/rows")
        months = {n.split("=")[1] for n in folder.children() if n.startswith("_month=")} - {"none"}
        border = before.strftime("%Y-%m")
        removed = 0
        schema = self._appended(table).schema if months else None
        for month in sorted(m for m in months if m < border):
            removed += self.spark.read.parquet(f"{folder.path}/_month={month}").count()
            folder.delete(f"_month={month}")
        if border in months:
            rows = self.spark.read.schema(schema).option("basePath", folder.path).parquet(f"{folder.path}/_month={border}")
            # the month comes back as it was written, whatever type a reader infers for it
            rows = rows.withColumn("_month", F.lit(border))
            held = scratch_dir(self.spark, "log")
            stay = ~F.coalesce(F.col(column) < F.lit(before).cast(schema[column].dataType), F.lit(False))
            rows.where(stay).write.parquet(held)
            kept = self.spark.read.parquet(held)
            left = kept.count()
            gone = rows.count() - left
            if gone and left:
                kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_month").parquet(folder.path)
            elif gone:
                folder.delete(f"_month={border}")
            removed += gone
        return removed
