"""Data-quality rules measured in one aggregate pass.

``quality_report`` returns one row per check (lazy, one job).  ``check_metrics`` gives the
aggregate expressions so a caller can evaluate them while writing (``DataFrame.observe``)
instead of reading the data a second time; ``unique`` needs ``count(DISTINCT)``, which an
observation cannot hold, so it is listed separately.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, NumericType, TimestampNTZType, TimestampType

from flowtable.errors import DataQualityError
from flowtable.functions.columns import col

RULES = ("not_null", "unique", "greater_than", "min_rows", "timestamp_format")

# Failure texts, kept word for word as the original tool prints them.
MESSAGES = {
    "not_null": "{name}: '{column}' has {n} null value(s)",
    "unique": "{name}: '{column}' has {n} duplicate value(s)",
    "greater_than": "{name}: '{column}' has {n} value(s) not greater than {threshold}",
    "min_rows": "{name}: expected at least {threshold} rows, got {n}",
    "timestamp_format": "{name}: '{column}' has {n} invalid timestamp(s)",
    "missing_column": "{name}: column '{column}' not found in data",
}
FAILURE_HEADER = "Data quality checks failed:"
FAILURE_BULLET = "  ✗ "


@dataclass(frozen=True)
class Check:
    name: str
    column: str | None
    rule: str
    value: float | None = None
    formats: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.rule not in RULES:
            raise ValueError(f"unknown quality rule '{self.rule}' in check '{self.name}'; known: {RULES}")


def _threshold(check: Check):
    if check.rule == "greater_than":
        return check.value if check.value is not None else 0
    if check.rule == "min_rows":
        return int(check.value) if check.value is not None else 1
    return None


def _violations(df: DataFrame, check: Check) -> Column | None:
    """Aggregate expression counting the check's violations; None if its column is missing."""
    if check.rule == "min_rows":
        return F.count(F.lit(1))  # row count; shortfall is derived from it
    if check.column not in df.columns:
        return None
    c = col(check.column)
    dtype = df.schema[check.column].dataType
    if isinstance(dtype, (DoubleType, FloatType)):
        c = F.when(~F.isnan(c), c)  # NaN counts as missing, as in the original tool
    if check.rule == "not_null":
        return F.count_if(c.isNull())
    if check.rule == "unique":
        # rows beyond the first of each value; all NULLs count as one value
        null_seen = F.coalesce(F.max(F.when(c.isNull(), 1).otherwise(0)), F.lit(0))
        return F.count(F.lit(1)) - F.count_distinct(c) - null_seen
    if check.rule == "greater_than":
        num = c.cast("double") if isinstance(dtype, NumericType) else c.try_cast("double")
        return F.count_if(num <= F.lit(float(_threshold(check))))
    if check.rule == "timestamp_format":
        if isinstance(dtype, (TimestampType, TimestampNTZType, DateType)):
            return F.lit(0).cast("long")
        text = c.cast("string")
        tries = [F.try_to_timestamp(text)] + [F.try_to_timestamp(text, F.lit(f)) for f in check.formats]
        return F.count_if(c.isNotNull() & F.coalesce(*tries).isNull())
    raise AssertionError(check.rule)


def check_metrics(df: DataFrame, checks: Sequence[Check]) -> tuple[dict[str, Column], dict[str, Column]]:
    """(plain aggregates, distinct aggregates) keyed ``m0, m1, ...`` by check position."""
    plain, distinct = {}, {}
    for i, check in enumerate(checks):
        expr = _violations(df, check)
        if expr is None:
            continue
        (distinct if check.rule == "unique" else plain)[f"m{i}"] = expr.cast("long")
    return plain, distinct


def _message(check: Check, measured):
    """Failure text for one check: a str for a driver-side count, a Column for a lazy one."""
    head, tail = MESSAGES[check.rule].split("{n}")
    fill = {"name": check.name, "column": check.column, "threshold": _threshold(check)}
    head, tail = head.format(**fill), tail.format(**fill)
    if isinstance(measured, Column):
        return F.concat(F.lit(head), measured.cast("string"), F.lit(tail))
    return f"{head}{measured}{tail}"


def _missing(check: Check) -> str:
    return MESSAGES["missing_column"].format(name=check.name, column=check.column)


def quality_report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: check_name, column_name, rule, violations, passed, message.

    All checks share one aggregate over ``df``.  For ``min_rows`` the violation count is the
    number of missing rows.  A check on a missing column has NULL violations and fails.
    """
    checks = list(checks)
    plain, distinct = check_metrics(df, checks)
    metrics = {**plain, **distinct}
    agg = df.agg(*[e.alias(k) for k, e in metrics.items()]) if metrics else df.sparkSession.range(1).select()
    rows = []
    for i, check in enumerate(checks):
        key = f"m{i}"
        if key not in metrics:
            viol = F.lit(None).cast("long")
            passed = F.lit(False)
            msg = F.lit(_missing(check))
        elif check.rule == "min_rows":
            viol = F.greatest(F.lit(_threshold(check)).cast("long") - F.col(key), F.lit(0).cast("long"))
            passed = F.col(key) >= F.lit(_threshold(check))
            msg = _message(check, F.col(key))
        else:
            viol = F.col(key)
            passed = F.col(key) == 0
            msg = _message(check, F.col(key))
        rows.append(
            F.struct(
                F.lit(check.name).alias("check_name"),
                F.lit(check.column).cast("string").alias("column_name"),
                F.lit(check.rule).alias("rule"),
                viol.alias("violations"),
                passed.alias("passed"),
                F.when(~passed, msg).alias("message"),
            )
        )
    return agg.select(F.inline(F.array(*rows)))


def failures_from_metrics(checks: Sequence[Check], metrics: Mapping[str, int], columns: Sequence[str]) -> list[str]:
    """Failure messages from measured values (``m<i>`` keys, as produced by ``check_metrics``)."""
    out = []
    for i, check in enumerate(checks):
        if check.rule != "min_rows" and check.column not in columns:
            out.append(_missing(check))
            continue
        value = int(metrics[f"m{i}"] or 0)
        if check.rule == "min_rows":
            if value < _threshold(check):
                out.append(_message(check, value))
        elif value > 0:
            out.append(_message(check, value))
    return out


def raise_on_failures(failures: Sequence[str]) -> None:
    if failures:
        raise DataQualityError(FAILURE_HEADER + "\n" + "\n".join(FAILURE_BULLET + f for f in failures))


def assert_quality(df: DataFrame, checks: Sequence[Check] | None, enabled: bool = True) -> None:
    """Raise ``DataQualityError`` listing every failed check; no-op when disabled or empty."""
    if not enabled or not checks:
        return
    report = quality_report(df, checks).where(~F.col("passed")).select("message").collect()
    raise_on_failures([r["message"] for r in report])
