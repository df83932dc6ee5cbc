"""How the schema of a stored table may change.

A column may be added and a type widened without touching a file: files are
read with the table's schema, Spark's reader turns the narrower values into the
wider ones, and a column a file lacks has its default.  Text becomes a declared
type only by writing the table anew, and only if every value fits.  A batch with
a narrower type than the table's is no change.  Everything else is an error.
"""

from __future__ import annotations

from pyspark.sql import types as T

DEFAULT = "EXISTS_DEFAULT"  # metadata key under which Spark's readers look for the value of a missing column

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


class SchemaConflict(ValueError):
    """A change of a column's type that stored values do not survive."""


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``old`` is one of ``new``, and files of ``old`` can be read as ``new``."""
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return old != new and new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    if old in _WHOLE and new in _WHOLE:
        return _WHOLE.index(old) < _WHOLE.index(new)
    pairs = [(T.FloatType(), T.DoubleType()), (T.IntegerType(), T.DoubleType()), (T.DateType(), T.TimestampNTZType())]
    return (old, new) in pairs


def evolved(stored: T.StructType, declared: T.StructType) -> tuple[T.StructType, list[str]]:
    """The stored schema with everything declared in it, and the columns whose rows must be written anew."""
    wanted, out, anew = {f.name: f for f in declared}, [], []
    for f in stored:
        new = wanted.pop(f.name, f)
        if widens(f.dataType, new.dataType):
            f = T.StructField(f.name, new.dataType, True, f.metadata)
        elif f.dataType == T.StringType() and new.dataType != T.StringType():
            f = T.StructField(f.name, new.dataType)
            anew.append(f.name)
        elif f.dataType != new.dataType and not widens(new.dataType, f.dataType):
            raise SchemaConflict(f"column {f.name} is {f.dataType.simpleString()} and cannot become {new.dataType.simpleString()}")
        out.append(f)
    return T.StructType([*out, *wanted.values()]), anew


def declared_field(name: str, dtype: T.DataType, default: str | None = None) -> T.StructField:
    """A column with the value (as text) that rows written without it have."""
    text = None if default is None else default.replace("\\", "\\\\").replace("'", "\\'")
    return T.StructField(name, dtype, True, {} if text is None else {DEFAULT: f"CAST('{text}' AS {dtype.simpleString()})"})


def default_of(field: T.StructField) -> str:
    """The default as a SQL expression."""
    return field.metadata.get(DEFAULT, f"CAST(NULL AS {field.dataType.simpleString()})")


def with_metadata(fields: T.StructType, stored: T.StructType | None) -> T.StructType:
    """Fields of rows that were just written, with what the table says about them."""
    known = {f.name: f for f in stored or []}
    return T.StructType([known[f.name] if f.name in known and known[f.name].dataType == f.dataType else f for f in fields])
