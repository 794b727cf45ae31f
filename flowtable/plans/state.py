"""Run state as one append-only journal table in the warehouse.

Every state change is an event row: ``register`` (a spec's fields), ``run`` (one finished
load), ``mark`` (a high-water mark), ``schema`` (one column of a schema snapshot) and
``version`` (a changed spec fingerprint).  No event is ever changed, and the usual tables --
registry, run log, marks, schemas, versions -- are views that take the latest event per key
(``max_by`` over event time and a sequence number).

A load buffers its events and appends them in one write when it finishes (success or
failure), and reads everything it needs about its past (last version, mark, stored
schema compared with the incoming one) in one small query of its name's partition.  Writers
never share a folder, and compaction never hides an event written beside it (``journal``).
"""

from __future__ import annotations

import hashlib
import json
import time
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from flowtable.functions.columns import status_symbol, utc_now
from flowtable.operators.runlog import run_health
from flowtable.operators.schema import drift_lines, schema_compare, schema_drift, schema_rows
from flowtable.operators.sinks import Warehouse
from flowtable.plans.journal import Journal

S, L, TS = StringType(), LongType(), TimestampNTZType()

JOURNAL_TABLE = "meta_journal"
NEVER_RUN = "NEVER RUN"  # fixed value: status shown for a registered name without runs
_FIELDS = [
    ("kind", S),
    ("pipeline_name", S),
    ("at", TS),
    ("seq", L),
    ("run_id", S),
    # register
    ("owner", S),
    ("source_type", S),
    ("source_identifier", S),
    ("destination_schema", S),
    ("destination_table", S),
    ("schedule", S),
    ("load_mode", S),
    ("is_active", BooleanType()),
    # run
    ("status", S),
    ("rows_extracted", L),
    ("rows_loaded", L),
    ("execution_time_seconds", DoubleType()),
    ("error_message", S),
    ("rows_without_key", L),
    ("rows_late", L),
    # mark
    ("incremental_key", S),
    ("max_value", S),
    # schema
    ("snapshot_seq", L),
    ("column_name", S),
    ("column_type", S),
    ("ordinal", IntegerType()),
    # version
    ("version_hash", S),
    ("config_snapshot", S),
]
JOURNAL = StructType([StructField(n, t) for n, t in _FIELDS])
_INDEX = {n: i for i, (n, _) in enumerate(_FIELDS)}

# Column names and order of the run log and the registry, which users' reports read.
RUN_COLUMNS = ["run_id", "pipeline_name", "run_timestamp", "status", "rows_extracted", "rows_loaded",
               "execution_time_seconds", "error_message", "rows_without_key", "rows_late"]
REGISTRY_FIELDS = ["owner", "source_type", "source_identifier", "destination_schema", "destination_table",
                   "schedule", "load_mode", "is_active"]


def _seq() -> int:
    return time.time_ns()


def _event(kind: str, pipeline_name: str, **values) -> tuple:
    row = [None] * len(_FIELDS)
    row[_INDEX["kind"]] = kind
    row[_INDEX["pipeline_name"]] = pipeline_name
    row[_INDEX["at"]] = values.pop("at", None) or utc_now()
    row[_INDEX["seq"]] = values.pop("seq", None) or _seq()
    for k, v in values.items():
        row[_INDEX[k]] = v
    return tuple(row)


def spec_fingerprint(spec) -> tuple[str, str]:
    """(16-hex SHA-256 of the sorted-key JSON of the tracked fields, that JSON)."""
    snapshot = json.dumps(spec.tracked_fields(), sort_keys=True)
    return hashlib.sha256(snapshot.encode("utf-8")).hexdigest()[:16], snapshot


@dataclass
class Probe:
    """What a load needs to know about its past, read in one query."""

    version_hash: str | None
    mark: str | None
    drift: list[str]
    stored_before: bool


class RunState:
    """Registry, run log, schema snapshots, high-water marks and spec versions."""

    def __init__(self, warehouse: Warehouse, compact_at_files: int = 512, check_every: int = 1) -> None:
        """``compact_at_files``: compact the segments of a name's partition once that many have piled up
        (0 turns it off), whichever processes wrote them; checked after every ``check_every`` appends."""
        self.wh = warehouse
        self.spark = warehouse.spark
        self._journal = Journal(warehouse, JOURNAL_TABLE, JOURNAL, "pipeline_name")
        self._pending: list[tuple] | None = None
        self._compact_at = compact_at_files
        self._check_every = max(1, check_every)
        self._appends = 0

    # -- writing
    def _add(self, rows: list[tuple]) -> None:
        if self._pending is not None:
            self._pending.extend(rows)
        else:
            self._write(rows)

    def _write(self, rows: list[tuple]) -> None:
        if not rows:
            return
        buckets = self._journal.append(rows)
        self._appends += 1
        if self._compact_at and self._appends % self._check_every == 0:
            for bucket in buckets:
                self._journal.compact_full_levels(bucket, max(2, self._compact_at))

    @contextmanager
    def deferred(self):
        """Collect events and append them in one write on exit (also when the body raises)."""
        outer = self._pending
        self._pending = [] if outer is None else outer
        try:
            yield self
        finally:
            if outer is None:
                rows, self._pending = self._pending, None
                self._write(rows)

    # -- reading
    def journal(self, pipeline_name: str | None = None) -> DataFrame:
        """All events, or those of one name, each once."""
        return self._journal.once(self._journal.scan(pipeline_name))

    def _kind(self, kind: str, pipeline_name: str | None = None) -> DataFrame:
        """Events of a kind, for uses that need each event once."""
        return self._journal.once(self._latest(kind, pipeline_name))

    def _latest(self, kind: str, pipeline_name: str | None = None) -> DataFrame:
        """Events of a kind, for uses that take the latest or least: an event may come twice."""
        return self._journal.scan(pipeline_name).where(F.col("kind") == F.lit(kind))

    @staticmethod
    def tables() -> list[str]:
        return [JOURNAL_TABLE]

    # -- run log
    def log_run(self, run_id, pipeline_name, status, rows_extracted, rows_loaded, execution_time_seconds, error_message,
                rows_without_key=0, rows_late=0) -> None:
        """Record one finished load; an absent error is stored as NULL."""
        self._add([_event("run", pipeline_name, run_id=run_id, status=status, rows_extracted=int(rows_extracted),
                          rows_loaded=int(rows_loaded), execution_time_seconds=float(execution_time_seconds),
                          error_message=error_message, rows_without_key=int(rows_without_key), rows_late=int(rows_late))])

    def runs(self) -> DataFrame:
        return self._kind("run").withColumnRenamed("at", "run_timestamp").select(*RUN_COLUMNS)

    # -- registry
    def register(self, spec) -> None:
        """Record the spec's current fields; the latest registration wins, the first sets created_at."""
        self._add([_event("register", spec.name, owner=spec.owner, source_type=spec.source.type,
                          source_identifier=spec.source.identifier, destination_schema=spec.destination.schema,
                          destination_table=spec.destination.table, schedule=spec.schedule,
                          load_mode=spec.load_mode, is_active=True)])

    def pipelines(self) -> DataFrame:
        """One row per registered name: latest registration fields, creation time, and the last
        run's time and status from the run log (NULL if it never ran)."""
        order = F.struct("at", "seq")
        latest = self._latest("register").groupBy("pipeline_name").agg(
            *[F.max_by(F.col(c), order).alias(c) for c in REGISTRY_FIELDS],
            F.min("at").alias("created_at"),
            F.max("at").alias("_registered_at"),
        )
        last_run = self._latest("run").groupBy("pipeline_name").agg(
            F.max("at").alias("last_run_at"),
            F.max_by("status", order).alias("last_status"),
        )
        return (
            latest.join(last_run, "pipeline_name", "left")
            .withColumn("updated_at", F.greatest("_registered_at", "last_run_at"))
            .select("pipeline_name", *REGISTRY_FIELDS, "created_at", "updated_at", "last_run_at", "last_status")
        )

    def health(self) -> DataFrame:
        """Health summary: every registered name joined with its run statistics."""
        runs = self._kind("run").withColumnRenamed("at", "run_timestamp")
        report = run_health(runs, registered=self.pipelines(), tie="seq")
        return (
            report.withColumn("status", F.coalesce(F.col("last_status"), F.lit(NEVER_RUN)))
            .withColumn("indicator", status_symbol("last_status"))
            .orderBy("pipeline_name")
        )

    # -- schema snapshots
    def store_schema(self, pipeline_name: str, schema: StructType) -> None:
        """Record the whole column set as a new snapshot (it replaces the previous one)."""
        seq, now = _seq(), utc_now()
        self._add([
            _event("schema", pipeline_name, at=now, seq=seq + i, snapshot_seq=seq, column_name=f.name,
                   column_type=f.dataType.simpleString(), ordinal=i + 1)
            for i, f in enumerate(schema.fields)
        ])

    def stored_schema(self, pipeline_name: str) -> DataFrame:
        """Column rows of the latest snapshot; empty before the first load."""
        mine = self._kind("schema", pipeline_name)
        latest = self._latest("schema", pipeline_name).agg(F.max("snapshot_seq").alias("snapshot_seq"))
        return mine.join(latest, "snapshot_seq", "left_semi").select("column_name", "column_type", "ordinal")

    def is_empty(self, pipeline_name: str) -> bool:
        """True when nothing is recorded in the name's partition (a catalog listing, no Spark job)."""
        return self._journal.is_empty(pipeline_name)

    def stored_columns(self, pipeline_name: str) -> list[tuple[str, str]]:
        """(name, type) of the latest snapshot in column order (one row per column)."""
        if self.is_empty(pipeline_name):
            return []
        rows = self.stored_schema(pipeline_name).orderBy("ordinal").collect()
        return [(r["column_name"], r["column_type"]) for r in rows]

    def schema_drift(self, pipeline_name: str, schema: StructType) -> DataFrame:
        return schema_drift(self.stored_schema(pipeline_name), schema_rows(self.spark, schema))

    # -- high-water marks
    def _mark_of(self, pipeline_name: str, key: str) -> DataFrame:
        mine = self._latest("mark", pipeline_name).where(F.col("incremental_key") == F.lit(key))
        return mine.agg(F.max_by("max_value", F.struct("at", "seq")).alias("value"))

    def get_mark(self, pipeline_name: str, key: str) -> str | None:
        return self._mark_of(pipeline_name, key).first()["value"]

    def set_mark(self, pipeline_name: str, key: str, value: str, run_id: str | None = None) -> None:
        self._add([_event("mark", pipeline_name, incremental_key=key, max_value=value, run_id=run_id)])

    def loads_above(self, pipeline_name: str, key: str, dtype, lower: str) -> list[str]:
        """Run ids whose mark is above ``lower``: the loads that can hold rows above it."""
        marks = self._journal.scan(pipeline_name).where(F.col("kind").isin("held_mark", "mark") & (F.col("incremental_key") == F.lit(key)))
        above = marks.where(F.col("max_value").cast(dtype) > F.lit(lower).cast(dtype)).select("run_id").distinct()
        return [r[0] for r in above.collect() if r[0] is not None]

    def hold_mark(self, pipeline_name: str, key: str, value: str, run_id: str | None = None) -> None:
        """Record the mark a micro-batch reached without making it the stored mark yet."""
        self._add([_event("held_mark", pipeline_name, incremental_key=key, max_value=value, run_id=run_id)])

    def release_marks(self, pipeline_name: str, key: str, dtype) -> None:
        """Advance the stored mark to the greatest held one, also of earlier calls that were cut off."""
        held = self._journal.scan(pipeline_name).where(F.col("kind").isin("held_mark", "mark") & (F.col("incremental_key") == F.lit(key)))
        top = held.agg(F.max_by(F.struct("max_value", "run_id", "kind"),
                                F.struct(F.col("max_value").cast(dtype), F.col("kind") == "mark", "at", "seq")).alias("m")).first()["m"]
        if top is not None and top["kind"] == "held_mark":
            self.set_mark(pipeline_name, key, top["max_value"], top["run_id"])

    def end_call(self, pipeline_name: str, tag: str, batch_id: int) -> None:
        """Record that a streaming call ended: its mark covers all batches of the checkpoint up to this one."""
        self._add([_event("call_end", pipeline_name, run_id=tag, snapshot_seq=batch_id)])

    def last_ended_batch(self, pipeline_name: str, tag: str) -> int:
        """The last batch of a checkpoint's calls that ended; -1 before the first."""
        ends = self._latest("call_end", pipeline_name).where(F.col("run_id") == F.lit(tag))
        found = ends.agg(F.max("snapshot_seq")).first()[0]
        return -1 if found is None else found

    def marks(self) -> DataFrame:
        return self._kind("mark").select("pipeline_name", "incremental_key", "max_value", F.col("at").alias("recorded_at"), "run_id")

    # -- spec versions
    def _last_version(self, pipeline_name: str) -> DataFrame:
        mine = self._latest("version", pipeline_name)
        return mine.agg(F.max_by("version_hash", F.struct("at", "seq")).alias("value"))

    def record_version(self, spec, last_hash: str | None) -> bool:
        digest, snapshot = spec_fingerprint(spec)
        if last_hash == digest:
            return False
        self._add([_event("version", spec.name, version_hash=digest, config_snapshot=snapshot)])
        return True

    def track_version(self, spec) -> bool:
        """Record a version event when the spec's tracked fields changed.  True if recorded."""
        return self.record_version(spec, self._last_version(spec.name).first()["value"])

    def versions(self) -> DataFrame:
        return self._kind("version").select("pipeline_name", "version_hash", "config_snapshot",
                                            F.col("at").alias("recorded_at"), "seq")

    # -- one-query probe for a load
    def probe(self, spec, incoming: StructType) -> Probe:
        """Last version hash, current mark and the schema comparison, in one small job."""
        name = spec.name
        if self.is_empty(name):  # nothing recorded yet: no version, no mark, no stored schema
            return Probe(None, None, [], False)
        key = spec.source.incremental_key
        none_s, none_i = F.lit(None).cast("string"), F.lit(None).cast("int")
        parts = [self._last_version(name).select(F.lit("version").alias("part"), F.col("value").alias("a"),
                                                 none_s.alias("b"), none_s.alias("c"), none_s.alias("d"),
                                                 none_i.alias("so"), none_i.alias("io"))]
        if key:
            parts.append(self._mark_of(name, key).select(F.lit("mark"), F.col("value"), none_s, none_s, none_s, none_i, none_i))
        cmp = schema_compare(self.stored_schema(name), schema_rows(self.spark, incoming))
        parts.append(cmp.select(F.lit("schema"), "column_name", "change", "stored_type", "incoming_type",
                                "stored_ordinal", "incoming_ordinal"))
        out = parts[0]
        for p in parts[1:]:
            out = out.union(p)
        rows = out.collect()  # one row each for version and mark, one per column for the schema
        version = next((r["a"] for r in rows if r["part"] == "version"), None)
        mark = next((r["a"] for r in rows if r["part"] == "mark"), None)
        cols = [{"column_name": r["a"], "change": r["b"], "stored_type": r["c"], "incoming_type": r["d"],
                 "stored_ordinal": r["so"], "incoming_ordinal": r["io"]}
                for r in rows if r["part"] == "schema"]
        stored_before = any(c["stored_type"] is not None for c in cols)
        drift = drift_lines([c for c in cols if c["change"] is not None]) if stored_before else []
        return Probe(version, mark, drift, stored_before)

    def has_succeeded(self, run_id: str, pipeline_name: str) -> bool:
        """Whether a run with this id already completed (replay guard for streaming batches)."""
        if self.is_empty(pipeline_name):
            return False
        done = self._latest("run", pipeline_name).where((F.col("run_id") == F.lit(run_id)) & (F.col("status") == "SUCCESS"))
        return not done.isEmpty()

    # -- maintenance
    def compact(self) -> None:
        """Make one segment of each name partition, sorted by name, kind and time, so that parquet
        statistics let a load's probe skip row groups of other names."""
        for bucket in range(self._journal.buckets):
            self._journal.compact(bucket)
