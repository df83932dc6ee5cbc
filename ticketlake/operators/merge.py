"""Upsert of a batch into a table, as a function from old state to new state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketlake.operators.dedup import first_per_key
from ticketlake.operators.lookups import fits_broadcast
from ticketlake.schemas import strings

ACTION = "merge_action"  # insert, update, unchanged or keep


def create_if_missing(spark: SparkSession, batch: DataFrame) -> DataFrame:
    """The empty all-string table a first batch creates."""
    return spark.createDataFrame([], strings(batch.columns))


def default_key(df: DataFrame) -> str:
    return "sys_id" if "sys_id" in df.columns else df.columns[0]


def split_batch(source: DataFrame, key: str, order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(last row per key, rows without a key), without the rank columns."""
    keyed, loose = source.where(F.col(key).isNotNull()), source.where(F.col(key).isNull())
    if order:
        keyed = first_per_key(keyed, key, [F.desc(c) for c in order]).drop(*order)
        loose = loose.drop(*order)
    return keyed, loose


def merge_actions(
    target: DataFrame,
    source: DataFrame,
    key: str | None = None,
    order: list[str] | None = None,
    small_source: bool | None = None,
) -> DataFrame:
    """New state of ``target`` after the upsert, each row tagged with what happened.

    Matched rows take every source column, NULLs included; columns only the
    target has keep their value.  Rows without a key are always inserted.
    ``order`` ranks the copies of a key (the last one wins) and is not stored.

    A source small enough to broadcast never shuffles the target: the target is
    read through a map-side join, and new keys are those a narrow key scan does
    not find.  A larger source takes one full outer join; both sides have one
    row per key there, and rows without a key go around it.
    """
    key = key or default_key(source)
    if small_source is None:
        small_source = fits_broadcast(source)
    keyed, loose = split_batch(source, key, order)
    columns = keyed.columns
    missing = {c: F.lit(None).cast(keyed.schema[c].dataType) for c in columns if c not in target.columns}
    target = target.withColumns(missing) if missing else target
    types = {f.name: f.dataType for f in target.schema.fields}

    # The source row travels as one struct.  Renaming its columns one by one above
    # a hash of all of them would make the optimiser derive a constraint for every
    # mix of old and new names.
    def side(rows: DataFrame) -> DataFrame:
        row = F.struct(*[F.col(c).cast(types[c]).alias(c) for c in columns])
        return rows.select(F.col(key).cast(types[key]).alias("_s_key"), row.alias("_s"))

    def inserted(rows: DataFrame) -> DataFrame:
        values = [
            (F.col("_s").getField(c) if c in columns else F.lit(None).cast(types[c])).alias(c) for c in target.columns
        ]
        return rows.select(*values, F.lit("insert").alias(ACTION))

    new, old = side(keyed), target.where(F.col(key).isNotNull()).withColumn("_t", F.lit(True))
    on = F.col(key) == F.col("_s_key")
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col("_s").getField(c))
    action = (
        F.when(F.col("_t").isNull(), "insert")
        .when(F.col("_s").isNull(), "keep")
        .when(same, "unchanged")
        .otherwise("update")
    )
    merged = [
        F.when(F.col("_s").isNotNull(), F.col("_s").getField(c)).otherwise(F.col(c)).alias(c)
        if c in columns
        else F.col(c)
        for c in target.columns
    ]
    if small_source:
        state = old.join(new, on, "left").select(*merged, action.alias(ACTION))
        known = old.select(key).join(new.select("_s_key"), on, "left_semi").distinct()
        state = state.unionByName(inserted(new.join(known, on, "left_anti")))
    else:
        state = old.join(new, on, "full_outer").select(*merged, action.alias(ACTION))
    without_key = target.where(F.col(key).isNull()).withColumn(ACTION, F.lit("keep"))
    return state.unionByName(inserted(side(loose))).unionByName(without_key)


def merged_rows(
    old: DataFrame | None, batch: DataFrame, key: str, order: list[str] | None, bucket: Column
) -> DataFrame:
    """The buckets of a stored table after the upsert: their rows, ``merge_action`` and ``_bucket``.

    ``old`` has the buckets' rows and ``_bucket``.  Rows and batch are read once
    and meet by bucket, so every bucket is written by one task.  Copies of a key
    are cut in the batch before that; without ``order`` its greatest row counts.
    """
    order = order or []
    quoted = lambda *names: ".".join(f"`{n}`" for n in names)
    columns = [c for c in batch.columns if c not in order]
    stored = [f for f in old.schema if f.name != "_bucket"] if old is not None else []
    types = {f.name: f.dataType.simpleString() for f in stored}
    # rows without a key are all different
    batch = batch.select("*", F.when(F.col(key).isNull(), F.monotonically_increasing_id()).alias("_own"))
    if order:
        copies = Window.partitionBy(key, "_own").orderBy(*[F.desc(c) for c in order])
        batch = batch.withColumn("_rn", F.row_number().over(copies)).where("_rn = 1")
    # expressions as text: tables are wide, and every call to the JVM counts
    typed = [f"CAST({quoted(c)} AS {types[c]})" if c in types else quoted(c) for c in columns]
    row = ", ".join(f"'{c}', {v}" for c, v in zip(columns, typed, strict=True))
    key_text = f"CAST({quoted(key)} AS STRING) AS _key"
    new = batch.select(bucket.alias("_bucket"), F.expr(key_text), "_own", F.expr(f"named_struct({row}) AS _s"))
    if old is not None:
        row = ", ".join(f"'{c}', {quoted(c)}" for c in types)
        both = new.unionByName(
            old.selectExpr("_bucket", key_text, "CAST(NULL AS BIGINT) AS _own", f"named_struct({row}) AS _t"), allowMissingColumns=True
        )
    else:
        both = new.withColumn("_t", F.lit(None).cast("struct<_:int>"))
    one = both.repartition("_bucket").groupBy("_bucket", "_key", "_own").agg(F.max("_s").alias("_s"), F.max("_t").alias("_t"))
    same = " AND ".join(
        f"{quoted('_s', c)} <=> {quoted('_t', c)}" if c in types else f"{quoted('_s', c)} IS NULL" for c in columns
    )
    action = (
        f"CASE WHEN _t IS NULL THEN 'insert' WHEN _s IS NULL THEN 'keep' WHEN {same} THEN 'unchanged' ELSE 'update' END"
        f" AS {ACTION}"
    )
    values = []
    for c in [*types, *(c for c in columns if c not in types)]:
        before, given = quoted("_t", c) if c in types else "NULL", quoted("_s", c)
        value = f"CASE WHEN _s IS NOT NULL THEN {given} ELSE {before} END" if c in columns else before
        values.append(f"{value} AS {quoted(c)}")
    return one.selectExpr(*values, action, "_bucket")


def merge_upsert(target: DataFrame, source: DataFrame, key: str | None = None, order=None, **kw) -> DataFrame:
    return merge_actions(target, source, key, order, **kw).drop(ACTION)


def source_actions(
    target: DataFrame | None, source: DataFrame, key: str | None = None, order: list[str] | None = None
) -> DataFrame:
    """The batch itself, last copy per key, each row tagged insert, update or unchanged.

    Of the target only the rows with a key of the batch take part; they are
    picked by a semi-join, so a small batch does not shuffle the target.
    """
    key = key or default_key(source)
    keyed, loose = split_batch(source, key, order)
    insert = F.lit("insert").alias(ACTION)
    if target is None:
        return keyed.unionByName(loose).select("*", insert)
    columns = keyed.columns
    compared = [c for c in columns if c in target.columns]
    as_text = lambda c: F.col(c).cast("string")
    ids = keyed.select(as_text(key).alias("_id"))
    known = target.where(F.col(key).isNotNull()).join(ids, as_text(key) == F.col("_id"), "left_semi")
    known = known.select(*[as_text(c).alias(f"_t_{c}") for c in compared], F.lit(True).alias("_t"))
    same = F.lit(len(compared) == len(columns))
    for c in compared:
        same = same & as_text(c).eqNullSafe(F.col(f"_t_{c}"))
    action = F.when(F.col("_t").isNull(), "insert").when(same, "unchanged").otherwise("update")
    joined = keyed.join(known, as_text(key) == F.col(f"_t_{key}"), "left").select(*columns, action.alias(ACTION))
    return joined.unionByName(loose.select("*", insert))


def merge_metrics(actions: DataFrame) -> DataFrame:
    """Counts of one merge: rows written, and how each came about."""
    count = lambda name: F.count_if(F.col(ACTION) == name).alias(name)
    return actions.agg(
        F.count_if(F.col(ACTION).isin("insert", "update")).alias("records_written"),
        count("insert"), count("update"), count("unchanged"), count("keep"),
    ).withColumnsRenamed({"insert": "inserted", "update": "updated", "keep": "untouched"})
