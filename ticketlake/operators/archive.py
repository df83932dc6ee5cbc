"""Archive entries: sizes, slice replacement, newest entries, aggregates."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.functions import columns as C
from ticketlake.functions.periods import to_day

# From so many zeros on, a running average may be halved to nothing (the least double is 2 ** -1074).
LONG_RUN = 900
# After so many saves a negative average is a positive one again (ratios have two decimals).
AFTER_NEGATIVE = 64


def iso_text(col: Column) -> Column:
    """ISO-8601 text; the fraction only when there is one."""
    fraction = F.when(F.date_format(col, "SSSSSS") != "000000", F.date_format(col, ".SSSSSS")).otherwise("")
    return F.concat(F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss"), fraction)


def record_json(df: DataFrame, name: str = "record", keep: dict[str, Column] | None = None) -> DataFrame:
    """Each row as compact JSON: nulls left out, text unescaped, dates as ISO text; ``keep`` adds columns beside it."""
    columns = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            col = iso_text(col)
        columns.append(col.alias(field.name))
    return df.select(F.to_json(F.struct(*columns)).alias(name), *[c.alias(n) for n, c in (keep or {}).items()])


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, one row per table."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(name).alias("table_name"), "record_count")
        out = row if out is None else out.unionByName(row)
    return out


def batch_metadata(tables: dict[str, DataFrame]) -> DataFrame:
    """Envelope metadata: table_count, total_records, and the counts of non-empty tables."""
    counts = table_counts(tables)
    return counts.agg(
        F.count(F.lit(1)).alias("table_count"),
        F.sum("record_count").alias("total_records"),
        F.to_json(
            F.map_from_entries(
                F.array_sort(
                    F.collect_list(F.when(F.col("record_count") > 0, F.struct("table_name", "record_count")))
                )
            )
        ).alias("records_by_table"),
    )


def entry_sizes(json_bytes: Column, compressed_bytes: Column | None) -> dict[str, Column]:
    """Sizes in KB and the saving in per cent, 2 places; exact zeros become NULL."""
    raw = json_bytes.cast("decimal(30,0)")
    out = {"json_size_kb": C.fixed(raw / 1024)}
    if compressed_bytes is None:
        nothing = F.lit(None).cast("decimal(38,2)")
        return {**out, "compressed_size_kb": nothing, "compression_ratio": nothing}
    packed = compressed_bytes.cast("decimal(30,0)")
    ratio = F.when(raw > 0, (raw - packed) * 100 / raw)
    return {
        **out,
        "compressed_size_kb": F.when(packed != 0, C.fixed(packed / 1024)),
        "compression_ratio": F.when(ratio != 0, C.fixed(ratio)),
    }


def replace_slice(
    existing: DataFrame,
    new: DataFrame,
    extraction_type: str,
    start: date | str | None = None,
    end: date | str | None = None,
    *,
    as_of: date | datetime,
) -> DataFrame:
    """Entries after a save: the slice's old entries go, the new ones come.

    With a window the slice is (start, end, type); else all of ``backlog``; else
    (today, type).  A comparison with NULL keeps the row, as a delete would.
    """
    same_type = F.col("extraction_type") == extraction_type
    day = lambda v: F.lit(to_day(v)).cast("date")
    if start and end:
        gone = same_type & (F.col("start_date") == day(start)) & (F.col("end_date") == day(end))
    elif extraction_type == "backlog":
        gone = same_type
    else:
        gone = same_type & (F.col("data_extraction") == day(as_of))
    kept = existing.where(~F.coalesce(gone, F.lit(False)))
    return kept.unionByName(new, allowMissingColumns=True)


def replace_windows(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Entries after a save of several windows: each replaces the entries of its own type and window."""
    window = ["extraction_type", "start_date", "end_date"]
    kept = existing.join(new.select(*window).distinct(), window, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def latest_entries(entries: DataFrame) -> DataFrame:
    """The newest entry per (extraction date, type)."""
    return (
        entries.groupBy("data_extraction", "extraction_type")
        .agg(F.max_by(F.struct(*entries.columns), F.struct("created_at", "id")).alias("_e"))
        .select("_e.*")
    )


def listing(entries: DataFrame, ordered: bool = True) -> DataFrame:
    """Entries, newest first if ``ordered``, with absent sizes shown as 0."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    rows = entries.orderBy(F.desc("created_at"), F.desc("id")) if ordered else entries
    return rows.select(
        "id", "data_extraction", "extraction_type", zero("record_count"), zero("json_size_kb"),
        zero("compressed_size_kb"), zero("compression_ratio"), "created_at",
    )


def recent(entries: DataFrame, n: int = 5) -> DataFrame:
    return listing(entries).limit(n)


def summary(entries: DataFrame, as_of: datetime) -> DataFrame:
    """Entries with the size they really take and their age in days."""
    return entries.withColumns({
        "effective_size_kb": F.coalesce("compressed_size_kb", "json_size_kb"),
        "days_old": F.datediff(F.lit(as_of).cast("date"), F.to_date("created_at")),
    })


def by_date(entries: DataFrame) -> DataFrame:
    return (
        entries.groupBy("data_extraction")
        .agg(
            F.sum("record_count").alias("total_records"),
            F.sum("json_size_kb").alias("total_json_kb"),
            F.sum(F.coalesce("compressed_size_kb", "json_size_kb")).alias("total_effective_kb"),
            C.mean(F.col("compression_ratio")).alias("avg_compression_ratio"),
        )
        .orderBy(F.desc("data_extraction"))
    )


def by_type(entries: DataFrame) -> DataFrame:
    return entries.groupBy("extraction_type").agg(
        F.count(F.lit(1)).alias("extractions_count"),
        C.mean(F.col("json_size_kb")).alias("avg_json_size_kb"),
        C.mean(F.col("compressed_size_kb")).alias("avg_compressed_size_kb"),
        C.mean(F.col("compression_ratio")).alias("avg_compression_ratio"),
        C.mean(F.col("record_count")).alias("avg_records_per_extraction"),
    )


def totals(entries: DataFrame) -> DataFrame:
    """Sums (NULL counts 0) and the mean of the positive ratios (0 when there is none)."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return entries.agg(
        total("record_count").alias("total_records"),
        total("json_size_kb").alias("total_json_size_kb"),
        total("compressed_size_kb").alias("total_compressed_size_kb"),
        F.coalesce(C.mean_positive(F.col("compression_ratio")), F.lit(0)).alias("average_compression_ratio"),
    )


def running_ratio(entries: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The ratio kept while saving: the first ratio while it is 0, then ``(old + new) / 2`` per save.

    A stretch of saves turns an average ``a`` into ``a / 2**n + s``, so every day
    is first collapsed to that form and only the days are combined in order.
    Zeros halve the average; where so many follow each other that it may reach 0
    and start anew, a stretch ends, and there the halving is done step by step.
    A save may also meet its exact opposite: for AFTER_NEGATIVE saves after a
    negative ratio every one is a step of its own.
    """
    order = order or ["created_at", "id"]
    by_day = Window.partitionBy("day").orderBy(*order)
    saves = (
        entries.where(F.col("compression_ratio").isNotNull())
        .select(*order, F.col("compression_ratio").cast("double").alias("ratio"), F.to_date(order[0]).alias("day"))
        .withColumn("nth", F.row_number().over(by_day))
    )
    parted = (
        saves.where("ratio <> 0")
        .withColumn("zeros", F.col("nth") - F.lag("nth", 1, 0).over(by_day) - 1)
        .withColumn("negative", F.max(F.when(F.col("ratio") < 0, F.col("nth"))).over(by_day.rowsBetween(Window.unboundedPreceding, -1)))
    )
    any_negative = saves.select(F.coalesce(F.min("ratio") < 0, F.lit(False)).alias("b")).scalar()
    since = F.col("nth") - F.coalesce("negative", F.lit(0))
    alone = (F.col("zeros") >= LONG_RUN) | (any_negative & (since <= AFTER_NEGATIVE))
    parted = parted.withColumn("part", F.sum(F.when(alone, 1).otherwise(0)).over(by_day))
    whole = Window.partitionBy("day", "part")
    bounded = parted.withColumns({"first": F.min("nth").over(whole), "last": F.max("nth").over(whole)})
    later = F.col("nth") > F.col("first")
    weight = F.pow(F.lit(2.0), F.col("nth") - F.col("last") - 1)
    stretches = bounded.groupBy("day", "part", "first", "last").agg(
        F.sum(F.when(~later, F.col("zeros"))).alias("zeros"),
        F.sum(F.when(~later, F.col("ratio"))).alias("ratio"),
        F.coalesce(F.sum(F.when(later, F.col("ratio") * weight)), F.lit(0.0)).alias("rest"),
    )
    ends = saves.groupBy("day").agg(
        F.max("nth").alias("n"), F.coalesce(F.max(F.when(F.col("ratio") != 0, F.col("nth"))), F.lit(0)).alias("last")
    )
    step = lambda at, zeros, ratio, n, rest: F.struct(
        "day", at.alias("at"), zeros.cast("int").alias("zeros"), ratio.alias("ratio"), n.cast("int").alias("n"), rest.alias("rest")
    )
    c, none = F.col, F.lit(None).cast("double")
    steps = stretches.select(
        step(c("first"), c("zeros"), c("ratio"), c("last") - c("first"), c("rest")).alias("step")
    ).union(ends.select(step(c("n") + 1, c("n") - c("last"), none, F.lit(0), none).alias("step")))

    def halved(avg, times):
        slowly = F.aggregate(F.sequence(F.lit(1), F.least(times, F.lit(2200))), avg, lambda a, _: a / 2)
        return F.when(times < LONG_RUN, avg * F.pow(F.lit(2.0), -times)).otherwise(slowly)

    def combine(avg, s):
        old = halved(avg, s["zeros"])
        first = F.when(old == 0, s["ratio"]).otherwise((old + s["ratio"]) / 2)
        return F.when(s["ratio"].isNull(), old).otherwise(first * F.pow(F.lit(2.0), -s["n"]) + s["rest"])

    return steps.agg(F.array_sort(F.collect_list("step")).alias("steps")).select(
        F.aggregate("steps", F.lit(0.0), combine).alias("running_ratio")
    )


def save_metrics(entries: DataFrame) -> DataFrame:
    """Saves, total and mean sizes, records, and the running ratio."""
    sums = entries.agg(
        F.count(F.lit(1)).alias("total_saves"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("json_size_kb"), F.lit(0)).alias("total_json_size_kb"),
        F.coalesce(F.sum("compressed_size_kb"), F.lit(0)).alias("total_compressed_size_kb"),
    )
    mean = lambda c: C.safe_ratio(F.col(c), F.col("total_saves"))
    compressed = entries.where(F.coalesce(F.col("compressed_size_kb"), F.lit(0)) != 0)
    return sums.select(
        "*",
        mean("total_json_size_kb").alias("avg_json_size_kb"),
        mean("total_compressed_size_kb").alias("avg_compressed_size_kb"),
        F.coalesce(running_ratio(compressed).scalar(), F.lit(0.0)).alias("avg_compression_ratio"),
    )
