"""Row filters and SQL transforms that rebuild derived tables."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtable.functions.columns import audit_timestamp, normalized_text, strict_timestamp


def keep_rows(
    df: DataFrame,
    equals: Mapping[str, Any] | None = None,
    positive: Sequence[str] = (),
    not_null: Sequence[str] = (),
) -> DataFrame:
    """Conjunctive filter: ``col = value`` for each pair, ``col > 0``, ``col IS NOT NULL``."""
    cond = F.lit(True)
    for c, v in (equals or {}).items():
        cond = cond & (F.col(c) == F.lit(v))
    for c in positive:
        cond = cond & (F.col(c) > 0)
    for c in not_null:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def clean_events(
    df: DataFrame,
    event_id: str = "event_id",
    user_id: str = "user_id",
    ts: str = "event_timestamp",
    event_type: str = "event_type",
    audit: bool = True,
) -> DataFrame:
    """Analytics-ready events: mandatory ids and time, positive user, typed time, tidy type."""
    kept = keep_rows(df, positive=[user_id], not_null=[event_id, user_id, ts])
    cols = [
        F.col(event_id),
        F.col(user_id),
        strict_timestamp(ts).alias(ts),
        normalized_text(event_type).alias(event_type),
    ]
    if audit:
        cols.append(audit_timestamp().alias("processed_at"))
    return kept.select(*cols)


_NAME = r"((?:`(?:[^`]|``)+`|\w+)(?:\s*\.\s*(?:`(?:[^`]|``)+`|\w+))*)"
_CTAS = re.compile(
    rf"^create\s+(or\s+replace\s+)?table\s+(if\s+not\s+exists\s+)?{_NAME}\s+as\s+(.*)$",
    re.IGNORECASE | re.DOTALL,
)
_DROP = re.compile(rf"^drop\s+table\s+(if\s+exists\s+)?{_NAME}(?:\s+purge)?$", re.IGNORECASE)
_PART = re.compile(r"`((?:[^`]|``)+)`|(\w+)")
# outside quotes: a quoted run, a line comment, a block comment, or the end of a statement
_TOKEN = re.compile(r"('(?:[^']|'')*'?|\"(?:[^\"]|\"\")*\"?|`(?:[^`]|``)*`?)|(--[^\n]*|/\*(?!\+).*?(?:\*/|\Z))|(;)", re.DOTALL)


def _statements(text: str) -> list[str]:
    """Split on ``;`` and drop comments, both only outside quotes; optimizer hints stay."""
    out, at, current = [], 0, []
    for m in _TOKEN.finditer(text):
        current.append(text[at:m.start()])
        at = m.end()
        if m[1]:
            current.append(m[1])
        elif m[2]:
            current.append(" " if m[2].startswith("/*") else "")
        else:
            out.append("".join(current))
            current = []
    out.append("".join([*current, text[at:]]))
    return [stmt.strip() for stmt in out if stmt.strip()]


def _table_name(warehouse, name: str) -> str:
    """The table of a possibly qualified name; other databases than the warehouse's are refused."""
    parts = [(q.replace("``", "`") if q else plain) for q, plain in _PART.findall(name)]
    if len(parts) > 2 or (len(parts) == 2 and parts[0].lower() != warehouse.database.lower()):
        raise ValueError(f"a transform writes tables of {warehouse.database}, not {name}")
    return parts[-1]


def load_sql(sql_or_path: str) -> str:
    """SQL text, read from a file when given a ``.sql`` path (missing file raises)."""
    if sql_or_path.strip().lower().endswith(".sql") and "\n" not in sql_or_path:
        if not os.path.exists(sql_or_path):
            raise FileNotFoundError(f"SQL transform file not found: {sql_or_path}")
        with open(sql_or_path, encoding="utf-8") as fh:
            return fh.read()
    return sql_or_path


def run_sql_transform(warehouse, sql_or_path: str, target: str | None = None, params=None) -> dict[str, int]:
    """Run a transform against the warehouse and publish each derived table.

    Accepts a bare SELECT (``target`` names the table) or statements.  ``CREATE [OR REPLACE] TABLE t
    AS SELECT ...`` publishes a new snapshot; with ``IF NOT EXISTS`` an existing table is left as it is,
    and without either an existing table that was not dropped before is an error.  ``DROP TABLE t`` takes
    effect when the script ends, unless a later statement rebuilds the table: then readers see the old
    rows until the new ones are published.  Other statements run as they are.  Unqualified names resolve
    in the warehouse database.  Returns rows written per table.
    """
    spark = warehouse.spark
    written: dict[str, int] = {}
    dropped: set[str] = set()
    previous_db = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(warehouse.database)
    try:
        for stmt in _statements(load_sql(sql_or_path)):
            drop, create = _DROP.match(stmt), _CTAS.match(stmt)
            if drop:
                name = _table_name(warehouse, drop[2])
                if not drop[1] and (name in dropped or not warehouse.exists(name)):
                    raise ValueError(f"DROP TABLE: no table {name}")
                dropped.add(name)
            elif create:
                name = _table_name(warehouse, create[3])
                there = warehouse.exists(name) and name not in dropped
                if there and create[2]:
                    continue
                if there and not create[1]:
                    raise ValueError(f"CREATE TABLE: table {name} exists")
                written[name] = warehouse.replace_from_sql(name, create[4], params)
                dropped.discard(name)
            elif target is not None and stmt.lower().startswith(("select", "with")):
                written[target] = warehouse.replace_from_sql(target, stmt, params)
                dropped.discard(target)
            else:
                for name in dropped:  # they must not see a table that is gone
                    warehouse.drop(name)
                dropped.clear()
                spark.sql(stmt, args=params) if params else spark.sql(stmt)
        for name in dropped:
            warehouse.drop(name)
    finally:
        spark.catalog.setCurrentDatabase(previous_db)
    return written
