"""Column expressions shared by the operators.  All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.schemas import HASH_IGNORED_FIELDS, HASH_IGNORED_PREFIX


def not_empty(col: Column) -> Column:
    """Neither NULL nor the empty string."""
    return col.isNotNull() & (col != F.lit(""))


def flag(col: Column) -> Column:
    """Source flag to 1/0: true, "true" and "1" are 1, everything else (NULL too) is 0."""
    return F.when(col.cast("string").isin("true", "1"), F.lit(1)).otherwise(F.lit(0))


def is_set(df: DataFrame, name: str) -> Column:
    """A flag column of any type as a condition; numbers and booleans stay pushable filters."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.BooleanType):
        return F.col(name)
    if isinstance(kind, T.NumericType):
        return F.col(name) == 1
    return flag(F.col(name)) == 1


def hash_fields(columns: list[str]) -> list[str]:
    """Columns the change hash looks at, sorted by name."""
    return sorted(
        c for c in columns
        if not c.startswith(HASH_IGNORED_PREFIX) and c not in HASH_IGNORED_FIELDS
    )


def row_hash(columns: list[str]) -> Column:
    """md5 over the tracked columns.

    Every value is written as ``name=length:value`` (``name=-`` for NULL), so no
    two different rows share a text: NULL, the empty string and values that
    contain separators all stay apart.
    """
    parts = []
    for name in hash_fields(columns):
        text = F.col(f"`{name}`").cast("string")
        parts.append(
            F.concat(
                F.lit(f"{name}="),
                F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")),
            )
        )
    return F.md5(F.concat_ws(";", *parts))


def period_label(start: Column, end: Column) -> Column:
    """``start``, ``start até end`` or ``N/A``."""
    s, e = F.date_format(start, "yyyy-MM-dd"), F.date_format(end, "yyyy-MM-dd")
    return (
        F.when(start == end, s)
        .when(start.isNotNull() & end.isNotNull(), F.concat(s, F.lit(" até "), e))
        .otherwise(F.lit("N/A"))
    )


def yes_no(col: Column) -> Column:
    """1 / true to ``Sim``, everything else (NULL too) to ``Não``."""
    return F.when(col.cast("int") == 1, F.lit("Sim")).otherwise(F.lit("Não"))


def fixed(col: Column, places: int = 2) -> Column:
    """Round half up on exact decimals (a double can sit just off a tie)."""
    return F.round(col.cast("decimal(38,10)"), places)


def safe_ratio(num: Column, den: Column, default: float | None = 0) -> Column:
    """num / den where den > 0, else the default."""
    return F.when(den > 0, F.try_divide(num, den)).otherwise(F.lit(default))


def success_rate(requests: Column, failed: Column) -> Column:
    """Per cent of requests that worked; 0 requests count as one."""
    return (requests - failed) / F.greatest(requests, F.lit(1)) * 100


def mean(col: Column) -> Column:
    """Mean as a double from the exact sum, so it does not depend on the row order."""
    return F.try_divide(F.sum(col).cast("double"), F.count(col))


def mean_positive(col: Column) -> Column:
    """Mean over values above zero only."""
    return mean(F.when(col > 0, col))


def value_bytes(columns: list[str]) -> Column:
    """UTF-8 bytes of all values of a row (NULL counts 0)."""
    total = F.lit(0).cast("long")
    for c in columns:
        total = total + F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0))
    return total


def short_text(col: Column, limit: int = 50) -> Column:
    """First ``limit`` characters, followed by ``...`` if the text is longer."""
    return F.when(F.length(col) > limit, F.concat(F.substring(col, 1, limit), F.lit("..."))).otherwise(col)
