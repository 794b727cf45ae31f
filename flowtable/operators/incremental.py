"""High-water-mark filtering: keep rows strictly above the stored mark of a key column.

The comparison is typed (the stored text mark is cast to the key's type), so numeric keys
compare as numbers and Catalyst pushes the predicate into columnar scans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, TimestampNTZType, TimestampType

from flowtable.errors import SourceError
from flowtable.functions.columns import col


def require_key(df: DataFrame, key: str) -> None:
    """Fail, naming the key and the available columns, when ``key`` is not a column."""
    if key not in df.columns:
        raise SourceError(f"incremental_key '{key}' not found in columns: {list(df.columns)}")


def typed_mark(df: DataFrame, key: str, mark: str) -> Column:
    return F.lit(mark).cast(df.schema[key].dataType)


def mark_text(value: Column, dtype: DataType) -> Column:
    """A mark as stored text.  Zone-aware timestamps keep their offset (ISO 8601), so the
    mark means the same instant whatever the session time zone of a later run."""
    if isinstance(dtype, TimestampType):
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return value.cast("string")


def look_back_from(df: DataFrame, key: str, mark: str, look_back: str) -> Column:
    """The mark minus an interval (``"36 hours"``) for a time or date key, or minus a number for a numeric one."""
    dtype, typed = df.schema[key].dataType, typed_mark(df, key, mark)
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        return (typed.cast("timestamp_ntz" if isinstance(dtype, DateType) else dtype) - F.expr(f"INTERVAL {look_back}")).cast(dtype)
    if isinstance(dtype, NumericType):
        return typed - F.lit(look_back).cast(dtype)
    raise SourceError(f"incremental_key '{key}' is {dtype.simpleString()}: a look-back needs a time, a date or a number")


def with_late_rows(
    df: DataFrame, key: str, mark: str, look_back: str, loaded: DataFrame, unique_key: Sequence[str], with_null_keys: bool = False
) -> DataFrame:
    """Rows above the mark, and rows at or below it, back to ``look_back``, that equal no row of ``loaded`` in ``unique_key``.

    One scan of each side: the source above the lower bound, the loaded rows between the bounds with their
    unique key alone.  NULLs in a unique key equal each other.
    """
    require_key(df, key)
    missing = [c for c in unique_key if c not in df.columns]
    if missing:
        raise SourceError(f"unique_key {missing} not found in columns: {list(df.columns)}")
    lower, upper = look_back_from(df, key, mark, look_back), typed_mark(df, key, mark)
    above = col(key) > lower
    rows = df.where(above | col(key).isNull() if with_null_keys else above)
    there = loaded.where((col(key) > lower) & (col(key) <= upper)).select(
        *[col(c).cast(df.schema[c].dataType).alias(f"_there{i}") for i, c in enumerate(unique_key)]).distinct()
    same = col(key) <= upper  # newer rows match nothing
    for i, c in enumerate(unique_key):
        same = same & col(c).eqNullSafe(F.col(f"_there{i}"))
    return rows.join(there, same, "left_anti")


def incremental_filter(
    df: DataFrame, key: str, mark: str | None, partition_column: str | None = None, with_null_keys: bool = False
) -> DataFrame:
    """Rows with ``key > mark``; with no mark, every row with a non-NULL key.

    ``with_null_keys`` lets rows without a key through as well, for a caller that counts them.

    ``partition_column`` names a partition column whose value is ``CAST(key AS <its type>)``
    -- a monotone floor of the key such as ``dt = to_date(ts)``.  The filter then also holds
    ``partition_column >= CAST(mark AS <its type>)``, which prunes whole partitions at
    planning time; the exact ``key > mark`` test still decides row by row.
    """
    require_key(df, key)
    keep, null_key = col(key).isNotNull(), col(key).isNull()
    if mark is not None:
        typed = typed_mark(df, key, mark)
        keep = keep & (col(key) > typed)
        if partition_column is not None:
            require_key(df, partition_column)
            keep = keep & (col(partition_column) >= typed.cast(df.schema[partition_column].dataType))
            null_key = null_key & col(partition_column).isNull()  # the floor of a NULL key is NULL
    return df.where(keep | null_key if with_null_keys else keep)


def marks_by(df: DataFrame, key: str, by: Sequence[str], mark_col: str = "high_water_mark", count_col: str = "n_rows") -> DataFrame:
    """Per group: the high-water mark of ``key`` and the row count."""
    return df.groupBy(*by).agg(F.max(key).alias(mark_col), F.count(F.lit(1)).alias(count_col))
