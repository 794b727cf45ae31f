"""Column expressions used by the operators (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(name: str) -> Column:
    """The column called exactly ``name`` (dots and backticks are part of the name)."""
    return F.col("`" + name.replace("`", "``") + "`")


def _c(c: ColumnOrName) -> Column:
    return col(c) if isinstance(c, str) else c


def normalized_text(c: ColumnOrName) -> Column:
    """``LOWER(TRIM(x))``."""
    return F.lower(F.trim(_c(c)))


def strict_timestamp(c: ColumnOrName) -> Column:
    """``CAST(x AS TIMESTAMP)`` without a zone; a bad value fails the query under ANSI mode."""
    return _c(c).cast("timestamp_ntz")


def audit_timestamp() -> Column:
    """Processing time of the query (one constant per query), zone-free."""
    return F.current_timestamp().cast("timestamp_ntz")


def to_number(c: ColumnOrName) -> Column:
    """Numeric coercion; unparsable text becomes NULL."""
    return F.expr(f"try_cast({_sql(c)} AS DOUBLE)") if isinstance(c, str) else c.try_cast("double")


def parses_as_timestamp(c: ColumnOrName, formats: tuple[str, ...] = ()) -> Column:
    """True when the value parses as a timestamp (default cast rules, then each extra format)."""
    col = _c(c)
    tries = [F.try_to_timestamp(col)] + [F.try_to_timestamp(col, F.lit(f)) for f in formats]
    return F.coalesce(*tries).isNotNull()


def truncate(c: ColumnOrName, n: int) -> Column:
    """First ``n`` characters."""
    return F.substring(_c(c), 1, n)


def canonical_json(*cols: str) -> Column:
    """JSON object of the named columns with keys in sorted order, nulls kept."""
    return F.to_json(F.struct(*[col(c) for c in sorted(cols)]), {"ignoreNullFields": "false"})


def fingerprint(*cols: str, length: int = 16) -> Column:
    """First ``length`` hex chars of SHA-256 over the canonical JSON of the tracked columns.

    JSON keeps NULLs apart from text and quotes what separates values, so different rows have
    different bodies.
    """
    return F.substring(F.sha2(canonical_json(*cols), 256), 1, length)


# Run status indicators, as the original status report shows them.
STATUS_SYMBOLS = {"SUCCESS": "✓", "FAILED": "✗"}
NO_STATUS_SYMBOL = "—"


def status_symbol(c: ColumnOrName) -> Column:
    """Indicator for a run status (one ``when`` per known status)."""
    col = _c(c)
    out = None
    for status, symbol in STATUS_SYMBOLS.items():
        out = F.when(col == status, symbol) if out is None else out.when(col == status, symbol)
    return out.otherwise(NO_STATUS_SYMBOL)


def utc_now() -> datetime:
    """Current UTC time without a zone, for driver-side audit values."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _sql(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
