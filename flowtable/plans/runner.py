"""One table load end to end, and many loads in name order.

    probe (last version, mark, stored schema vs incoming: one query)
    -> drift gate -> key > mark -> one write that measures rows, mark and rule violations
    -> quality gate -> publish -> derived tables, SQL transform -> one journal append with every state event

The source is read and written once.  An append is published as a partition named by the run id
and an overwrite by pointing the table at what was written, so nothing is copied and a run that is
repeated with its id after a crash finds its rows published and only completes its state.  Every
attempt writes to a folder of its own.  Only a ``unique`` rule reads the written files again,
column-pruned, because an observation cannot hold DISTINCT.

A drifted load writes nothing: its rules are measured by an aggregate, so that quality failures are
still reported first, and then the drift is.  Rows with a NULL incremental key are never loaded; they
are counted in the result and the run log.  Failures are caught, recorded as FAILED and returned,
never raised.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flowtable.errors import SchemaDriftError
from flowtable.functions.columns import col
from flowtable.operators.changes import duplicate_keys, key_conflicts
from flowtable.operators.incremental import incremental_filter, look_back_from, mark_text, require_key, typed_mark, with_late_rows
from flowtable.operators.quality import check_metrics, failures_from_metrics, raise_on_failures
from flowtable.operators.refresh import refresh
from flowtable.operators.runlog import format_alert
from flowtable.operators.schema import drift_error_text
from flowtable.operators.sinks import LOAD_ID, Warehouse, align_by_name, nullable, observed, observed_rows
from flowtable.operators.transform import run_sql_transform
from flowtable.operators.zones import LandedFiles, landed_files, record_zones
from flowtable.plans.spec import LoadSpec
from flowtable.plans.state import RunState
from flowtable.sources.files import read_csv, read_source


@dataclass(frozen=True)
class PinnedMark:
    """The mark that all micro-batches of one streaming call compare with; the stored mark stays
    put until the call ends (each batch's mark is recorded as held)."""

    value: str | None


def _load_measures(df: DataFrame, key: str | None, mark: str | None) -> dict:
    """Row count, rows at or below the old mark, and the new mark (``greatest(max(key), old mark)``: it never moves backwards)."""
    measures = {"_rows": F.count(F.lit(1))}
    if key:
        new = F.max(col(key))
        if mark is not None:
            new = F.greatest(new, typed_mark(df, key, mark))
            measures["_late"] = F.count_if(col(key) <= typed_mark(df, key, mark))
        measures["_mark"] = mark_text(new, df.schema[key].dataType)
    return measures


def _aggregate(df: DataFrame, measures: dict) -> dict:
    return df.agg(*[e.alias(k) for k, e in measures.items()]).first().asDict()


def _distinct_metrics(df: DataFrame, checks) -> dict:
    """The ``unique`` rules one by one: each reads its column alone, where several DISTINCTs in one
    aggregate would copy every row once for each."""
    _, distinct = check_metrics(df, checks)
    return {k: df.agg(e.alias(k)).first()[0] for k, e in distinct.items()}


def measure(df: DataFrame, spec: LoadSpec, mark: str | None) -> dict:
    """The metrics of a load by aggregates over ``df``."""
    checks = spec.quality.checks if spec.quality.enabled else []
    plain, _ = check_metrics(df, checks)
    return _aggregate(df, {**_load_measures(df, spec.source.incremental_key, mark), **plain}) | _distinct_metrics(df, checks)


def write_and_measure(
    spark: SparkSession, df: DataFrame, spec: LoadSpec, path: str, mark: str | None, write: Callable[[DataFrame, str], None]
) -> tuple[DataFrame, dict]:
    """``write(df, path)`` while measuring the rows; returns (what was written, metrics).

    Metrics that do not arrive are taken from the written files.
    """
    checks = spec.quality.checks if spec.quality.enabled else []
    plain, _ = check_metrics(df, checks)
    measures = {**_load_measures(df, spec.source.incremental_key, mark), **plain}
    obs = Observation(f"load_{uuid.uuid4().hex[:8]}")
    write(df.observe(obs, *[e.alias(k) for k, e in measures.items()]), path)
    written = spark.read.schema(nullable(df.schema)).parquet(path)
    metrics = observed(obs)
    if metrics is None:
        return written, measure(written, spec, mark)
    return written, metrics | _distinct_metrics(written, checks)


def _read_for_load(spark: SparkSession, spec: LoadSpec, state: RunState) -> tuple[DataFrame, bool]:
    """Read the source; (frame, pinned).

    A CSV source without an explicit schema is read with the types of its stored schema
    snapshot once it has one and the header still names the same columns: one pass instead
    of an inference pass plus a read.  The read is FAILFAST, so a value that no longer fits
    its stored type stops the load, which then falls back to inference (see ``run_load``).
    """
    src = spec.source
    if src.type != "csv" or src.schema is not None or not src.pin_schema:
        return read_source(spark, src), False
    stored = state.stored_columns(spec.name)
    if not stored:
        return read_source(spark, src), False
    header = read_csv(spark, src.path, infer=False, check_quotes=False, **src.options).columns  # first line only
    if header != [name for name, _ in stored]:
        return read_source(spark, src), False
    ddl = ", ".join(f"`{name.replace('`', '``')}` {dtype}" for name, dtype in stored)
    return read_csv(spark, src.path, schema=ddl, **{**src.options, "mode": "FAILFAST"}), True


def _malformed(exc: Exception) -> bool:
    return "MALFORMED_RECORD_IN_PARSING" in str(exc)


def _write_increment(
    spark: SparkSession,
    spec: LoadSpec,
    warehouse: Warehouse,
    df: DataFrame,
    probe,
    mark: str | None,
    force: bool,
    run_id: str,
    counts: dict,
    state: RunState,
) -> dict:
    """Filter, gate and publish one increment; fills ``counts`` as it goes; returns metrics."""
    table = spec.destination.physical
    key = spec.source.incremental_key
    checks = spec.quality.checks if spec.quality.enabled else []
    nulls = None
    if key:
        nulls = Observation(f"nulls_{uuid.uuid4().hex[:8]}")
        if spec.source.look_back and mark is not None and warehouse.exists(table):
            loaded = _loaded_rows(df, spec, warehouse, state, mark)
            df = with_late_rows(df, key, mark, spec.source.look_back, loaded, spec.source.unique_key or df.columns, with_null_keys=True)
        else:
            df = incremental_filter(df, key, mark, spec.source.partition_column, with_null_keys=True)
        unkeyed = df.where(col(key).isNull())
        df = df.observe(nulls, F.count_if(col(key).isNull()).alias("rows")).where(col(key).isNotNull())

    def gate(metrics: dict) -> dict:
        counts["extracted"], counts["late"] = int(metrics["_rows"]), int(metrics.get("_late") or 0)
        if nulls is not None:
            counts["null_keys"] = observed_rows(nulls, lambda: unkeyed)
        raise_on_failures(failures_from_metrics(checks, metrics, df.columns))
        return metrics

    if probe.drift and not force:
        if checks:
            gate(measure(df, spec, mark))
        raise SchemaDriftError(drift_error_text(probe.drift))

    exists = warehouse.exists(table)
    if spec.load_mode == "overwrite":
        if exists and warehouse.is_load_table(table):
            raise ValueError(f"{table} is load-partitioned: it takes appends only (each load is a partition)")
        target = warehouse.schema(table) if exists else nullable(df.schema)
        bucketing = warehouse.bucketing(table) if exists else None
        aligned = align_by_name(df, target).columns  # fails before anything is written
        path = warehouse.snapshot_path(table)
        _, metrics = write_and_measure(
            spark, df, spec, path, mark,
            lambda rows, to: warehouse.write_snapshot(align_by_name(rows, target).select(*[col(c) for c in aligned]), to, bucketing))
        gate(metrics)
        if key and counts["extracted"] == 0:
            warehouse.ensure_table(table, target)  # nothing new: keep the current snapshot
        else:
            warehouse.adopt(table, path, target, bucketing)
        counts["loaded"] = counts["extracted"]
        return metrics

    if not spec.destination.load_partitions or (exists and not warehouse.is_load_table(table)):
        # a plain table: the stage is gated and then its files' rows are appended
        stage = warehouse.stage_path(table, run_id)
        staged, metrics = write_and_measure(spark, df, spec, stage, mark, _write_files)
        gate(metrics)
        if counts["extracted"] == 0:
            warehouse.ensure_table(table, df.schema)
        else:
            warehouse.append(table, staged)
        counts["loaded"] = counts["extracted"]
        return metrics

    if warehouse.has_load(table, run_id):  # published by an attempt that was lost before its state was written
        metrics = measure(warehouse.read_load(table, run_id), spec, mark)
        counts["extracted"], counts["null_keys"] = int(metrics["_rows"]), unkeyed.count() if key else 0
        counts["late"] = int(metrics.get("_late") or 0)
        counts["loaded"] = counts["extracted"]
        return metrics
    path = warehouse.load_path(table, run_id)
    written, metrics = write_and_measure(spark, df, spec, path, mark, _write_files)
    gate(metrics)
    if counts["extracted"] > 0:
        warehouse.publish_load(table, run_id, path, written.schema)
    else:
        warehouse.ensure_load_table(table, written.schema)
    counts["loaded"] = counts["extracted"]
    return metrics


def _loaded_rows(df: DataFrame, spec: LoadSpec, warehouse: Warehouse, state: RunState, mark: str) -> DataFrame:
    """What the destination holds; of a load-partitioned table only the loads that reach into the look-back."""
    table, key = spec.destination.physical, spec.source.incremental_key
    if not warehouse.is_load_table(table):
        return warehouse.read(table)
    dtype = df.schema[key].dataType
    lower = df.sparkSession.range(1).select(
        mark_text(look_back_from(df, key, mark, spec.source.look_back), dtype)).first()[0]
    recent = state.loads_above(spec.name, key, dtype, lower)
    rows = warehouse.read(table, load_id=True)
    return (rows.where(F.col(LOAD_ID).isin(recent)) if recent else rows).drop(LOAD_ID)


def _write_files(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").parquet(path)


def run_load(
    spark: SparkSession,
    spec: LoadSpec,
    warehouse: Warehouse,
    force: bool = False,
    source: DataFrame | None = None,
    state: RunState | None = None,
    on_failure: Callable[[str], None] | None = None,
    run_id: str | None = None,
    pinned: PinnedMark | None = None,
) -> dict:
    """Run one load.  ``source`` overrides reading ``spec.source`` (e.g. a frame from a stream);
    ``pinned`` overrides the stored mark and leaves it as it is.

    Never raises for a failed load: the failure is recorded and returned.  All state events of
    the load are appended in one write at the end; if that write fails, the load is reported as
    failed and can be repeated with its ``run_id``.
    """
    run_id = run_id or str(uuid.uuid4())
    start = time.time()
    counts = {"extracted": 0, "loaded": 0, "null_keys": 0, "late": 0}
    try:
        state = state or RunState(warehouse)
        with state.deferred():
            return _run_load(spark, spec, warehouse, force, source, state, on_failure, run_id, pinned, start, counts)
    except Exception as exc:  # noqa: BLE001 - the state could not be written
        return _result("failed", counts, round(time.time() - start, 2), f"run state not recorded: {exc}", run_id)


def _run_load(spark, spec, warehouse, force, source, state, on_failure, run_id, pinned, start, counts) -> dict:
    key = spec.source.incremental_key
    versioned = False
    state.register(spec)
    try:
        landed: LandedFiles | None = None
        if source is None and spec.source.zone_map:
            known = pinned.value if pinned else (None if state.is_empty(spec.name) else state.get_mark(spec.name, key))
            landed = landed_files(warehouse, spec.name, spec.source, known)
            df, typed = landed.rows, False
        else:
            df, typed = (source, False) if source is not None else _read_for_load(spark, spec, state)
        if key:
            require_key(df, key)
        probe = state.probe(spec, df.schema)  # version, mark and schema comparison: one query
        mark = pinned.value if pinned else probe.mark
        state.record_version(spec, probe.version_hash)
        versioned = True
        try:
            metrics = _write_increment(spark, spec, warehouse, df, probe, mark, force, run_id, counts, state)
        except Exception as exc:  # noqa: BLE001
            if not (typed and _malformed(exc)):
                raise
            # a value no longer fits its stored type: infer the types, then gate on drift as usual
            df = read_source(spark, spec.source)
            if key:
                require_key(df, key)
            probe = state.probe(spec, df.schema)
            metrics = _write_increment(spark, spec, warehouse, df, probe, mark, force, run_id, counts, state)

        if probe.drift or not probe.stored_before:  # the snapshot changes only with the column set
            state.store_schema(spec.name, df.schema)
        if key and metrics.get("_mark") is not None:
            (state.hold_mark if pinned else state.set_mark)(spec.name, key, metrics["_mark"], run_id)
        if landed is not None:
            record_zones(warehouse, spec.name, spec.source, landed)

        if spec.transform:
            for table in spec.transform.derived:
                refresh(warehouse, spec.destination.physical, table)
            if spec.transform.sql:
                run_sql_transform(warehouse, spec.transform.sql, spec.transform.target)

        duration = round(time.time() - start, 2)
        state.log_run(run_id, spec.name, "SUCCESS", counts["extracted"], counts["loaded"], duration, None, counts["null_keys"], counts["late"])
        return _result("success", counts, duration, None, run_id)
    except Exception as exc:  # noqa: BLE001 - every failure is recorded and returned
        duration = round(time.time() - start, 2)
        if not versioned:  # the spec version is recorded even when the source could not be read
            state.track_version(spec)
        state.log_run(run_id, spec.name, "FAILED", counts["extracted"], counts["loaded"], duration, str(exc), counts["null_keys"], counts["late"])
        if on_failure is not None and spec.notify_on_failure:
            try:
                on_failure(format_alert(spec.name, run_id, str(exc)))
            except Exception:  # noqa: BLE001 - delivery problems never hide the load error
                pass
        return _result("failed", counts, duration, str(exc), run_id)


def _result(status: str, counts: dict, duration: float, error: str | None, run_id: str) -> dict:
    return {
        "status": status,
        "run_id": run_id,
        "rows_extracted": counts["extracted"],
        "rows_loaded": counts["loaded"],
        "rows_without_key": counts["null_keys"],
        "rows_late": counts["late"],
        "execution_time_seconds": duration,
        "error_message": error,
    }


def destination_conflicts(spark: SparkSession, specs: Sequence[LoadSpec]) -> DataFrame:
    """Physical tables claimed by more than one spec, with the first claimant by name."""
    rows = [(s.destination.physical, s.name) for s in specs]
    claims = spark.createDataFrame(rows, "destination string, pipeline_name string")
    return key_conflicts(claims, "destination", "pipeline_name", first_col="first_claimant")


def duplicate_names(spark: SparkSession, specs: Sequence[LoadSpec]) -> DataFrame:
    """Spec names used more than once in one batch."""
    names = spark.createDataFrame([(s.name,) for s in specs], "pipeline_name string")
    return duplicate_keys(names, ["pipeline_name"])


def run_all(spark: SparkSession, specs: Sequence[LoadSpec], warehouse: Warehouse) -> list[dict]:
    """Check names and destination conflicts first, then run in name order; stop at the first failure."""
    dupes = duplicate_names(spark, specs).collect()
    if dupes:
        raise ValueError("Duplicate pipeline names: " + ", ".join(sorted(r["pipeline_name"] for r in dupes)))
    conflicts = destination_conflicts(spark, specs).collect()
    if conflicts:
        lines = [f"  '{r['destination']}' claimed by {r['n_owners']} specs (first: '{r['first_claimant']}')" for r in conflicts]
        raise ValueError("Duplicate destination tables detected:\n" + "\n".join(lines))
    state = RunState(warehouse)
    results = []
    for spec in sorted(specs, key=lambda s: s.name):
        res = run_load(spark, spec, warehouse, state=state)
        results.append({"pipeline_name": spec.name, **res})
        if res["status"] != "success":
            break
    return results
