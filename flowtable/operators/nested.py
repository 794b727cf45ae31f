"""Schema changes below the top level: differences with paths, and which of them only widen a type.

A path names struct fields (``a.b``), array elements (``a[]``), map keys and values (``m{key}``, ``m{value}``); a
name with other characters than letters, digits and ``_`` is quoted with backticks.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_PLAIN = re.compile(r"^\w+$")
# digits before the point that hold every value of an integral type
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}
# each type and those whose values include all of its values
_WIDER = {
    ByteType: (ShortType, IntegerType, LongType, FloatType, DoubleType),
    ShortType: (IntegerType, LongType, FloatType, DoubleType),
    IntegerType: (LongType, DoubleType),
    LongType: (),
    FloatType: (DoubleType,),
    DateType: (TimestampNTZType,),
}


def widens(stored: DataType, incoming: DataType) -> bool:
    """Whether every value of ``stored`` is one of ``incoming`` (and the types differ)."""
    if isinstance(stored, NullType):
        return not isinstance(incoming, NullType)
    if isinstance(incoming, DecimalType):
        whole = incoming.precision - incoming.scale
        if isinstance(stored, DecimalType):
            return stored != incoming and incoming.scale >= stored.scale and whole >= stored.precision - stored.scale
        return whole >= _DIGITS.get(type(stored), whole + 1)
    return isinstance(incoming, _WIDER.get(type(stored), ()))


@dataclass(frozen=True)
class Change:
    """One difference.  ``kind``: ``added``, ``removed``, ``widened`` or ``type_changed``."""

    path: str
    kind: str
    stored_type: str | None
    incoming_type: str | None


def _name(name: str) -> str:
    return name if _PLAIN.match(name) else "`" + name.replace("`", "``") + "`"


def _inside(path: str, stored: DataType, incoming: DataType) -> list[Change]:
    if isinstance(stored, StructType) and isinstance(incoming, StructType):
        return _fields(path + "." if path else "", stored, incoming)
    if isinstance(stored, ArrayType) and isinstance(incoming, ArrayType):
        return _inside(path + "[]", stored.elementType, incoming.elementType)
    if isinstance(stored, MapType) and isinstance(incoming, MapType):
        return (_inside(path + "{key}", stored.keyType, incoming.keyType)
                + _inside(path + "{value}", stored.valueType, incoming.valueType))
    old, new = stored.simpleString(), incoming.simpleString()
    if old == new:
        return []
    return [Change(path, "widened" if widens(stored, incoming) else "type_changed", old, new)]


def _fields(prefix: str, stored: StructType, incoming: StructType) -> list[Change]:
    old, new = ({f.name: f.dataType for f in s.fields} for s in (stored, incoming))
    out = [Change(prefix + _name(n), "removed", t.simpleString(), None) for n, t in old.items() if n not in new]
    for name, dtype in new.items():
        path = prefix + _name(name)
        out += _inside(path, old[name], dtype) if name in old else [Change(path, "added", None, dtype.simpleString())]
    return out


def schema_changes(stored: StructType, incoming: StructType) -> list[Change]:
    """Every difference at any depth: removed fields in stored order, then others in incoming order, struct by struct.

    Whether a column may be NULL and the order of fields do not count.
    """
    return _fields("", stored, incoming)


CHANGE_ROW = StructType([StructField(n, StringType()) for n in ("path", "change", "stored_type", "incoming_type")])


def schema_changes_frame(spark: SparkSession, stored: StructType, incoming: StructType) -> DataFrame:
    """``path, change, stored_type, incoming_type`` of every difference (schemas only, never data)."""
    return spark.createDataFrame([(c.path, c.kind, c.stored_type, c.incoming_type) for c in schema_changes(stored, incoming)], CHANGE_ROW)


def widened(stored: StructType, incoming: StructType) -> StructType | None:
    """``stored`` with the incoming types where these only widen it; None if any other difference exists."""
    if any(c.kind != "widened" for c in schema_changes(stored, incoming)):
        return None
    return StructType([StructField(f.name, incoming[f.name].dataType, f.nullable, f.metadata) for f in stored.fields])
