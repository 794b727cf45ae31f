"""Incremental loads as a Structured Streaming job with ``trigger(availableNow=True)``.

Each call processes every file that landed since the previous one (file progress lives in
the checkpoint) and then stops.  Each micro-batch goes through the same load as a batch run.
New files may repeat rows that *earlier calls* loaded, so every micro-batch of a call is compared
with the mark as it was when the call began; the stored mark advances when the call ends.  How the
backlog is cut into micro-batches, and in which order its files come, does not change the result.

A call that is cut off (a gate rejects a batch, the driver is lost) leaves loads that its mark does not
cover: the next call must still load older rows of the rest of that backlog.  So the next call keeps the
mark and leaves out the rows that equal a row of those loads.

With ``unique_key``, streaming state holds the keys seen so far, and a row whose key was seen is dropped
wherever it comes again: in the same file, later in a backlog, or after a call that was cut off.

``foreachBatch`` is at-least-once: a batch replayed after a crash carries the same batch id.  Its
run id is derived from (checkpoint, batch id); a batch whose run already succeeded is skipped,
and one that published its rows but lost its state only completes the state.  A batch that a gate
rejected is tried again by the next call, in a fresh folder; its keys are not in the state yet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType, VariantType

from flowtable.functions.columns import col
from flowtable.operators.sinks import LOAD_ID, Warehouse
from flowtable.plans.runner import PinnedMark, run_load
from flowtable.plans.spec import LoadSpec
from flowtable.plans.state import RunState

_SEEN = "_seen_key"


def _comparable(df: DataFrame) -> list:
    """The columns of ``df`` as expressions that can be compared (maps and variants by their JSON)."""
    return [F.to_json(col(f.name)) if isinstance(f.dataType, (MapType, VariantType)) else col(f.name) for f in df.schema.fields]


def first_of_each_key(rows: DataFrame, unique_key: Sequence[str], event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """Rows of a stream (or a batch) whose key was not seen before.

    The state keeps every key, spread by its hash over the shuffle partitions, and lives in the checkpoint;
    use the RocksDB state store where keys outgrow the executors' memory.  With ``event_time`` and ``delay``
    a key is forgotten ``delay`` after its time, which bounds the state; a row later than that behind the
    latest time seen is dropped by Spark, so choose a delay no file exceeds.  Rows with a NULL in their
    key are told apart by all their columns.
    """
    missing = [c for c in unique_key if c not in rows.columns]
    if missing:
        raise ValueError(f"unique key {missing} not in columns: {rows.columns}")
    incomplete = F.lit(False)
    for c in unique_key:
        incomplete = incomplete | col(c).isNull()
    whole_row = F.when(incomplete, F.sha2(F.to_json(F.struct(*[col(c) for c in rows.columns])), 256))
    keyed = rows.withColumn(_SEEN, F.struct(*[col(c).alias(f"k{i}") for i, c in enumerate(unique_key)], whole_row.alias("row")))
    if event_time is None:
        return keyed.dropDuplicates([_SEEN]).drop(_SEEN)
    return keyed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([_SEEN]).drop(_SEEN)


def rows_not_in(batch: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rows of ``batch`` that equal no row of ``loaded``, NULLs being equal (an anti join on the row's hash)."""
    loaded = loaded.select(*[col(f.name).cast(f.dataType).alias(f.name) for f in batch.schema.fields])
    there = loaded.select(F.xxhash64(*_comparable(loaded)).alias("_hash"), F.struct(*_comparable(loaded)).alias("_row"))
    here = batch.withColumn("_hash", F.xxhash64(*_comparable(batch))).withColumn("_row", F.struct(*_comparable(batch)))
    same = (F.col("b._hash") == F.col("l._hash")) & F.col("b._row").eqNullSafe(F.col("l._row"))
    return here.alias("b").join(there.distinct().alias("l"), same, "left_anti").drop("_hash", "_row")


def stream_load(
    spark: SparkSession,
    spec: LoadSpec,
    warehouse: Warehouse,
    landing: str,
    checkpoint: str,
    schema: StructType | str,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    state: RunState | None = None,
    max_files_per_batch: int | None = None,
    run_tag: str | None = None,
    unique_key: Sequence[str] | None = None,
    event_time: str | None = None,
    delay: str | None = None,
) -> list[dict]:
    """Load everything new under ``landing`` and stop.  Returns one result per micro-batch.

    Batch run ids are ``stream-<run_tag>-<batch id>``; the tag defaults to a hash of the
    checkpoint path, so a restarted query replaying a batch sees the same id.  ``unique_key``,
    ``event_time`` and ``delay``: see ``first_of_each_key``; a checkpoint keeps the choice it began with.
    Rows left out after a call that was cut off, like rows of a unique key, count as not extracted.
    """
    if (event_time is None) != (delay is None) or (event_time and not unique_key):
        raise ValueError("event_time and delay bound the state of a unique_key: give all three")
    state = state or RunState(warehouse)
    tag = run_tag or hashlib.sha1(checkpoint.encode()).hexdigest()[:12]
    results: list[dict] = []
    key = spec.source.incremental_key
    table = spec.destination.physical
    pinned = PinnedMark(state.get_mark(spec.name, key)) if key else None
    ended = state.last_ended_batch(spec.name, tag) if key else None
    # loads of calls that were cut off since; a few micro-batches
    uncovered = [i for i in warehouse.loads(table, f"stream-{tag}-") if _batch_of(i) > ended] if key else []
    last = ended

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        nonlocal last
        run_id = f"stream-{tag}-{batch_id}"
        if state.has_succeeded(run_id, spec.name):
            last = batch_id
            return
        before = [i for i in uncovered if i != run_id]
        if before and not unique_key:
            batch = rows_not_in(batch, warehouse.read(table, load_id=True).where(F.col(LOAD_ID).isin(before)).drop(LOAD_ID))
        # publish through the caller's session: foreachBatch hands us a cloned session whose
        # relation cache the caller would not see refreshed
        res = run_load(spark, spec, warehouse, source=batch, state=state, run_id=run_id, pinned=pinned)
        results.append(res)
        if res["status"] != "success":
            raise RuntimeError(f"batch {batch_id} failed: {res['error_message']}")
        last = batch_id

    reader = spark.readStream.schema(schema).format(fmt).options(**(options or {}))
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_batch))
    rows = reader.load(landing)
    if unique_key:
        rows = first_of_each_key(rows, unique_key, event_time, delay)
    query = (
        rows.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if key:
        dtype = (StructType.fromDDL(schema) if isinstance(schema, str) else schema)[key].dataType
        with state.deferred():  # the mark and the end of the call: one write
            state.release_marks(spec.name, key, dtype)
            if last != ended:
                state.end_call(spec.name, tag, last)
    for name in [table, *state.tables()]:
        if warehouse.exists(name):
            spark.catalog.refreshTable(warehouse.qualified(name))
    return results


def _batch_of(run_id: str) -> int:
    return int(run_id.rsplit("-", 1)[1])
