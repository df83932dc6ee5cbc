"""Record normalisation: references, schemas, flags, stamps, hashes, typed tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.functions import columns as C
from ticketlake.schemas import (
    COMPANY_FLAGS,
    DERIVED_PREFIX,
    NOW,
    REFERENCE_ID_FIELDS,
    TYPED_TABLES,
    TypedField,
)
from ticketlake.sources.evolution import declared_field


def _is_reference(value: str) -> str:
    # A path into text or a number yields NULL, and so does an object without the
    # key; a JSON null under the key does not.  Text that merely looks like an
    # object therefore never counts.
    return f"variant_get({value}, '$.value', 'variant') IS NOT NULL"


def discover_fields(records: DataFrame, column: str = "record") -> dict[str, bool]:
    """Field names of the records, each with whether it ever holds a reference object.

    One pass, pre-aggregated per task; what reaches the driver is the schema.
    """
    entries = records.select(
        F.explode(F.from_json(column, "MAP<STRING, VARIANT>")).alias("field", "value")
    )
    found = entries.groupBy("field").agg(F.expr(f"bool_or({_is_reference('value')})").alias("is_ref"))
    # the names become columns, so they are needed where the plan is made
    return {r["field"]: bool(r["is_ref"]) for r in sorted(found.collect(), key=lambda r: r["field"])}


def flatten_refs(
    records: DataFrame,
    fields: Iterable[str] | None = None,
    derived: Iterable[str] | None = None,
    column: str = "record",
) -> DataFrame:
    """Records (JSON text) to string columns; a reference object becomes its value.

    ``derived`` fields also get a ``dv_<field>`` column: empty text where the
    record held a reference, NULL elsewhere.  Without ``fields`` the names are
    discovered, and every field seen as a reference is a derived one.
    """
    if fields is None:
        seen = discover_fields(records, column)
        fields = list(seen)
        derived = [f for f, is_ref in seen.items() if is_ref] if derived is None else derived
    fields, derived = list(fields), list(derived or [])
    keep = [c for c in records.columns if c != column]
    schema = ", ".join(f"`{f}` VARIANT" for f in fields)
    parsed = records.select(*keep, F.from_json(column, schema).alias("_v"))
    values = [
        F.expr(
            f"if({_is_reference(f'_v.`{f}`')}, try_variant_get(_v.`{f}`, '$.value', 'string'),"
            f" try_variant_get(_v.`{f}`, '$', 'string'))"
        ).alias(f)
        for f in fields
    ]
    marks = [
        F.expr(f"if({_is_reference(f'_v.`{f}`')}, '', CAST(NULL AS STRING))").alias(DERIVED_PREFIX + f)
        for f in derived
    ]
    return parsed.select(*keep, *values, *marks)


def project_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns: missing ones are NULL, extra ones go."""
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def normalize_flags(df: DataFrame, fields: Iterable[str] = COMPANY_FLAGS) -> DataFrame:
    """Flags to 1/0, for the columns that exist."""
    present = {f: C.flag(F.col(f)) for f in fields if f in df.columns}
    return df.withColumns(present) if present else df


def audit_stamp(df: DataFrame, as_of: datetime) -> DataFrame:
    """One load time per run in both lineage columns."""
    now = F.lit(as_of).cast("timestamp_ntz")
    return df.withColumns({"etl_created_at": now, "etl_updated_at": now})


def add_row_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("etl_hash", C.row_hash(df.columns))


def drop_derived(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(DERIVED_PREFIX)])


def ensure_columns(df: DataFrame, fields: Iterable[str] = REFERENCE_ID_FIELDS) -> DataFrame:
    missing = {f: F.lit(None).cast("string") for f in fields if f not in df.columns}
    return df.withColumns(missing) if missing else df


def _default(field: TypedField, as_of: datetime):
    if field.default is None:
        return None
    if field.default == NOW:
        return F.lit(as_of).cast(field.dtype)
    return F.lit(field.default).cast(field.dtype)


def typed_conform(df: DataFrame, table: str, as_of: datetime) -> DataFrame:
    """Land text columns in a typed table: lenient casts, then the column defaults."""
    out = []
    for field in TYPED_TABLES[table]:
        default = _default(field, as_of)
        if field.name in df.columns:
            value = F.col(f"`{field.name}`").try_cast(field.dtype)
            value = F.coalesce(value, default) if default is not None else value
        else:
            value = default if default is not None else F.lit(None).cast(field.dtype)
        out.append(value.alias(field.name))
    return df.select(*out)


def conform_present(df: DataFrame, table: str, as_of: datetime, keep: Iterable[str] = ()) -> DataFrame:
    """``typed_conform`` of the declared columns that are there; others become text, those in ``keep`` stay."""
    declared = {f.name: f for f in TYPED_TABLES[table]}
    out = []
    for c in df.columns:
        value = F.col(f"`{c}`")
        if c not in keep and c in declared:
            default = _default(declared[c], as_of)
            value = value.try_cast(declared[c].dtype)
            value = value if default is None else F.coalesce(value, default)
        elif c not in keep:
            value = value.cast("string")
        out.append(value.alias(c))
    return df.select(*out)


def declared_schema(table: str, as_of: datetime) -> T.StructType:
    """The columns of a typed table with their defaults, as a stored table is told about them."""
    moment = as_of.isoformat(" ")
    return T.StructType([declared_field(f.name, f.dtype, moment if f.default == NOW else f.default) for f in TYPED_TABLES[table]])


def with_reject_reasons(df: DataFrame, table: str) -> DataFrame:
    """Adds ``reject_reason``: the broken column rules, comma-joined, or NULL for a good row."""
    checks = []
    for field in TYPED_TABLES[table]:
        if field.name not in df.columns:
            continue
        col = F.col(f"`{field.name}`")
        if field.required and field.default is None:
            checks.append(F.when(col.isNull(), F.lit(f"{field.name}:missing")))
        if field.max_length:
            checks.append(F.when(F.length(col.cast("string")) > field.max_length, F.lit(f"{field.name}:too long")))
        if not isinstance(field.dtype, T.StringType):
            checks.append(
                F.when(col.isNotNull() & col.try_cast(field.dtype).isNull(), F.lit(f"{field.name}:bad value"))
            )
    reason = F.concat_ws(",", *checks)
    return df.withColumn("reject_reason", F.when(reason != "", reason))


def split_rejects(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with their reasons)."""
    checked = with_reject_reasons(df, table)
    accepted = checked.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return accepted, checked.where(F.col("reject_reason").isNotNull())
