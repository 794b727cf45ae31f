"""Derived tables that follow a load-partitioned table load by load.

``RowTable`` is a projection with an optional filter; its rows of one load depend on that load alone, so each
load becomes one partition of the derived table.  ``GroupTable`` is a ``GROUP BY`` whose measures can be merged:
each load becomes one partition of partial aggregates, and the table itself is a view that merges the partials
of a group.  A refresh reads only the loads that are not there yet (partition pruning on the load id) and writes
only their rows or partials; a load is published under its own id, so a refresh that is repeated after a crash
adds nothing twice.

``fold`` merges all partials of a ``GroupTable`` into one partition once many loads have piled up.  It writes a
new generation of the partials, which no reader sees, and then replaces the view: one catalog call.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtable.functions.columns import col
from flowtable.operators.sinks import LOAD_ID, Warehouse, _q, _text, nullable

FOLDED = "folded"  # the partition that a fold writes
_PART = "_load_number"


@dataclass(frozen=True)
class RowTable:
    """``SELECT columns FROM source WHERE where``: output names and SQL expressions over the source's columns."""

    target: str
    columns: Mapping[str, str]
    where: str | None = None


@dataclass(frozen=True)
class Measure:
    """A mergeable aggregate: ``count`` (of ``*`` if no expression), ``sum``, ``min``, ``max``, ``avg`` or
    ``count_distinct``."""

    kind: str
    expr: str | None = None


@dataclass(frozen=True)
class GroupTable:
    """``SELECT keys, measures FROM source WHERE where GROUP BY keys``.

    One expression may be counted distinctly: its values are kept as rows of the partials, never as a
    list in one row.  Sums of floating-point values add up in another order than a rebuild's; sum
    decimals or integers where the last digits matter.
    """

    target: str
    keys: Mapping[str, str]
    measures: Mapping[str, Measure] = field(default_factory=dict)
    where: str | None = None

    def __post_init__(self) -> None:
        wrong = [m.kind for m in self.measures.values() if m.kind not in _PARTIALS]
        if wrong:
            raise ValueError(f"not mergeable: {wrong}; one of {sorted(_PARTIALS)}")
        lacking = [n for n, m in self.measures.items() if m.expr is None and m.kind != "count"]
        if lacking:
            raise ValueError(f"measures without an expression: {lacking}")
        if len({m.expr for m in self.measures.values() if m.kind == "count_distinct"}) > 1:
            raise ValueError("one expression can be counted distinctly; put another into a table of its own")

    @property
    def distinct(self) -> str | None:
        return next((m.expr for m in self.measures.values() if m.kind == "count_distinct"), None)


# for each kind: the partials (suffix, aggregate of the rows' expression) and how merged partials give the result
_PARTIALS = {
    "count": {"n": F.count},
    "sum": {"sum": F.sum},
    "min": {"min": F.min},
    "max": {"max": F.max},
    "avg": {"sum": lambda c: F.sum(c.cast("double")), "n": F.count},
    "count_distinct": {},
}
_MERGE = {"n": "sum", "sum": "sum", "min": "min", "max": "max"}
_KEY, _VALUE, _MEASURE = "k{}", "distinct_value", "m{}_{}"


def _source_rows(rows: DataFrame, columns: Mapping[str, Column], where: str | None) -> DataFrame:
    rows = rows.where(where) if where else rows
    return rows.select(*[e.alias(n) for n, e in columns.items()])


def partial_aggregates(rows: DataFrame, table: GroupTable, by: tuple[str, ...] = ()) -> DataFrame:
    """One row for each group (and value counted distinctly, and column of ``by``) of ``rows``."""
    rows = rows.where(table.where) if table.where else rows
    group = [col(c) for c in by] + [F.expr(e).alias(_KEY.format(i)) for i, e in enumerate(table.keys.values())]
    if table.distinct is not None:
        group.append(F.expr(table.distinct).alias(_VALUE))
    aggregates = [agg(F.lit(1) if m.expr is None else F.expr(m.expr)).alias(_MEASURE.format(i, suffix))
                  for i, m in enumerate(table.measures.values()) for suffix, agg in _PARTIALS[m.kind].items()]
    return rows.groupBy(*group).agg(*(aggregates or [F.lit(1).alias("_one")])).drop("_one")


def merge_sql(table: GroupTable, partials: str, result: bool) -> str:
    """SQL that merges partials of equal groups: into the table's result, or into fewer partials."""
    keys = [_KEY.format(i) for i in range(len(table.keys))]
    group = keys + ([_VALUE] if table.distinct is not None and not result else [])
    merged = lambda i, s: f"{_MERGE[s]}({_MEASURE.format(i, s)})"
    out = [f"{k} AS {_q(n)}" if result else k for k, n in zip(keys, table.keys)] + group[len(keys):]
    for i, (name, m) in enumerate(table.measures.items()):
        if not result:
            out += [f"{merged(i, s)} AS {_MEASURE.format(i, s)}" for s in _PARTIALS[m.kind]]
        elif m.kind == "count_distinct":
            out.append(f"count(DISTINCT {_VALUE}) AS {_q(name)}")
        elif m.kind == "avg":
            out.append(f"{merged(i, 'sum')} / {merged(i, 'n')} AS {_q(name)}")
        else:
            (suffix,) = _PARTIALS[m.kind]
            out.append(f"{merged(i, suffix)} AS {_q(name)}")
    return f"SELECT {', '.join(out)} FROM {partials}" + (f" GROUP BY {', '.join(group)}" if group else "")


def _unapplied(warehouse: Warehouse, source: str, derived: str, covered: set[str] = frozenset()) -> list[str]:
    if not warehouse.is_load_table(source):
        raise ValueError(f"{source} is not load-partitioned: its derived tables can't follow its loads")
    return sorted(set(warehouse.loads(source)) - set(warehouse.loads(derived)) - covered)


def unread_loads(warehouse: Warehouse, source: str, loads: list[str]) -> DataFrame:
    """The rows of these loads, with their load id; other partitions are not listed."""
    return warehouse.read(source, load_id=True).where(F.col(LOAD_ID).isin(loads))


def _publish(warehouse: Warehouse, derived: str, loads: list[str], rows: DataFrame) -> None:
    """Write the rows of several loads in one job, a folder for each, and publish each under its id."""
    path = f"{warehouse.root}/{derived}/loads/refresh-{uuid.uuid4().hex}"
    number = F.create_map(*[F.lit(x) for i, load in enumerate(loads) for x in (load, i)])
    rows.withColumn(_PART, F.element_at(number, F.col(LOAD_ID))).drop(LOAD_ID).write.partitionBy(_PART).parquet(path)
    schema = nullable(rows.drop(LOAD_ID).schema)
    for i, load in enumerate(loads):  # a load without rows has no folder: an empty partition
        warehouse.publish_load(derived, load, f"{path}/{_PART}={i}", schema)


LOADS_AT_ONCE = 256  # loads written by one job


def refresh_rows(warehouse: Warehouse, source: str, table: RowTable) -> list[str]:
    """Bring a ``RowTable`` up to date.  Returns the loads that were new to it."""
    pending = _unapplied(warehouse, source, table.target)
    columns = {n: F.expr(e) for n, e in table.columns.items()}
    for at in range(0, len(pending), LOADS_AT_ONCE):
        loads = pending[at:at + LOADS_AT_ONCE]
        _publish(warehouse, table.target, loads, _source_rows(
            unread_loads(warehouse, source, loads), {**columns, LOAD_ID: F.col(LOAD_ID)}, table.where))
    return pending


_GENERATION = "flowtable.partials"  # property of the view: the table of partials it reads


def _partials_of(warehouse: Warehouse, table: GroupTable) -> str | None:
    """The table of partials that the view reads now."""
    if not warehouse.exists(table.target):
        return None
    found = {r["key"]: r["value"] for r in warehouse.spark.sql(f"SHOW TBLPROPERTIES {warehouse.qualified(table.target)}").collect()}
    if _GENERATION not in found:
        raise ValueError(f"{table.target} exists and is not a derived table that follows loads")
    return found[_GENERATION]


def _show(warehouse: Warehouse, table: GroupTable, partials: str) -> None:
    """Make the view read ``partials`` (one catalog call)."""
    properties = f"({_text(_GENERATION)} = {_text(partials)}, 'flowtable.definition' = {_text(repr(table))})"
    warehouse.spark.sql(f"CREATE OR REPLACE VIEW {warehouse.qualified(table.target)} TBLPROPERTIES {properties} AS "
                        + merge_sql(table, warehouse.qualified(partials), result=True))


def _covered(warehouse: Warehouse, partials: str) -> set[str]:
    """Loads that a fold put into the folded partition of this generation."""
    done = f"{partials}__covers"
    return {r[0] for r in warehouse.read(done).collect()} if warehouse.exists(done) else set()


def refresh_groups(warehouse: Warehouse, source: str, table: GroupTable) -> list[str]:
    """Bring a ``GroupTable`` up to date.  Returns the loads that were new to it."""
    partials = _partials_of(warehouse, table)
    fresh = partials is None
    if fresh:
        partials = f"{table.target}__partials_{uuid.uuid4().hex[:8]}"
    pending = _unapplied(warehouse, source, partials, set() if fresh else _covered(warehouse, partials))
    for at in range(0, len(pending), LOADS_AT_ONCE):
        loads = pending[at:at + LOADS_AT_ONCE]
        _publish(warehouse, partials, loads, partial_aggregates(unread_loads(warehouse, source, loads), table, by=(LOAD_ID,)))
    if fresh:
        if not pending:
            empty = partial_aggregates(warehouse.read(source).limit(0), table)
            warehouse.ensure_load_table(partials, nullable(empty.schema))
        _show(warehouse, table, partials)
    return pending


def fold(warehouse: Warehouse, table: GroupTable) -> None:
    """Merge the partials of all loads into one partition, so that readers merge less."""
    old = _partials_of(warehouse, table)
    loads = sorted((set(warehouse.loads(old)) - {FOLDED}) | _covered(warehouse, old))
    new = f"{table.target}__partials_{uuid.uuid4().hex[:8]}"
    merged = warehouse.spark.sql(merge_sql(table, warehouse.qualified(old), result=False))
    path = warehouse.load_path(new, FOLDED)
    merged.write.mode("errorifexists").parquet(path)
    warehouse.append(f"{new}__covers", warehouse.spark.createDataFrame([(i,) for i in loads], "load string").coalesce(1))
    warehouse.publish_load(new, FOLDED, path, nullable(merged.schema))
    _show(warehouse, table, new)


def refresh(warehouse: Warehouse, source: str, table: RowTable | GroupTable) -> list[str]:
    """Bring a derived table of ``source`` up to date.  Returns the loads that were new to it."""
    return (refresh_rows if isinstance(table, RowTable) else refresh_groups)(warehouse, source, table)
