"""Verification queries: each operator applied to the driver's tables, with a DuckDB oracle.

Every query reads whole tables (no sampling, no key subsets).  Queries that exercise sinks
write into a fresh warehouse database under the shared scratch root and return a lazy read
of the published table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtable.functions.columns import fingerprint
from flowtable.operators.changes import duplicate_keys, key_conflicts, latest_by_key, track_versions, version_changes
from flowtable.operators.incremental import incremental_filter, marks_by
from flowtable.operators.keyed import KeyedTable
from flowtable.operators.quality import Check, quality_report
from flowtable.operators.refresh import GroupTable, Measure, RowTable, fold
from flowtable.operators.runlog import failure_alerts, latest_failure, run_health
from flowtable.operators.sinks import Warehouse
from flowtable.operators.transform import clean_events as clean_events_op
from flowtable.operators.transform import keep_rows, run_sql_transform
from flowtable.operators.zones import landed_files
from flowtable.plans.runner import destination_conflicts, run_all, run_load
from flowtable.plans.spec import DestinationSpec, LoadSpec, QualitySpec, SourceSpec, TransformSpec
from flowtable.plans.state import RunState
from flowtable.session import scratch_path
from flowtable.sources.catalog import as_relation, run_query
from flowtable.sources.files import read_csv, read_json, write_json_lines
from flowtable.streaming.available_now import stream_load

SPLIT = "2024-01-15 00:00:00"
VERSION_CUT = "1996-01-01 00:00:00"
LINEITEM_SPLIT = "1998-06-01 00:00:00"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, name: str) -> str:
    view = f"ft_{name}_{uuid.uuid4().hex[:8]}"
    as_relation(_t(spark, sf_dir, name), view)
    return view


# ----------------------------------------------------------------------------- filters, marks


def q_clean_orders(spark, sf):
    orders = _t(spark, sf, "orders")
    kept = keep_rows(orders, equals={"o_orderstatus": "F"}, positive=["o_totalprice"])
    return kept.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


def _untidy_events(spark, sf):
    """All events with times as text, types in mixed case and padded, and some users missing or zero."""
    return _t(spark, sf, "events").withColumns({
        "ts": F.col("ts").cast("string"),
        "event_type": F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("  "), F.upper("event_type"), F.lit(" "))).otherwise(
            F.initcap("event_type")),
        "user_id": F.when(F.col("event_id") % 11 == 0, None).when(F.col("event_id") % 13 == 0, 0).otherwise(F.col("user_id")),
    })


def q_clean_events(spark, sf):
    return clean_events_op(_untidy_events(spark, sf), ts="ts", audit=False)


def q_incremental_filter(spark, sf):
    return incremental_filter(_t(spark, sf, "events"), "ts", SPLIT)


def q_hwm_per_key(spark, sf):
    return marks_by(_t(spark, sf, "events"), "ts", ["event_type"])


# ----------------------------------------------------------------------------- quality

DQ_CHECKS = {
    "customer": [
        Check("acctbal_positive", "c_acctbal", "greater_than"),
        Check("custkey_present", "c_custkey", "not_null"),
        Check("balance_text_positive", "balance_text", "greater_than"),
        Check("column_gone", "no_such_column", "not_null"),
    ],
    "lineitem": [Check("orderkey_unique", "l_orderkey", "unique")],
    "events": [Check("event_type_is_time", "event_type", "timestamp_format")],
}

def _dq_faults() -> dict:
    """Faults put into whole tables, so that every rule has something to find and something to pass."""
    key, event = F.col("c_custkey"), F.col("event_id") % 3
    return {
        "customer": {"balance_text": F.when(key % 4 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string")),
                     "c_custkey": F.when(key % 9 != 0, key)},
        "lineitem": {},
        "events": {"event_type": F.when(event == 0, F.col("ts").cast("string")).when(event == 1, F.col("event_type"))},
    }


def q_dq_report(spark, sf):
    faults = _dq_faults()
    parts = [quality_report(_t(spark, sf, t).withColumns(faults[t]), checks) for t, checks in DQ_CHECKS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_dq_min_rows(spark, sf):
    checks = [Check("min_5", None, "min_rows", 5), Check("min_10000", None, "min_rows", 10000)]
    return quality_report(_t(spark, sf, "customer"), checks)


# ----------------------------------------------------------------------------- keyed changes


def q_upsert_latest(spark, sf):
    wh = Warehouse.scratch(spark, "upsert")
    events = _t(spark, sf, "events")
    split = F.lit(SPLIT).cast("timestamp_ntz")
    for part in (events.where(F.col("ts") <= split), events.where(F.col("ts") > split)):
        wh.upsert("user_latest", part, ["user_id"], order_by=["ts", "event_id"])
    return wh.read("user_latest")


def q_insert_if_absent(spark, sf):
    wh = Warehouse.scratch(spark, "absent")
    orders = _t(spark, sf, "orders")
    for _ in range(2):  # the second pass finds every key present and adds nothing
        wh.insert_if_absent("first_orders", orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return wh.read("first_orders")


def q_update_by_key(spark, sf):
    wh = Warehouse.scratch(spark, "update")
    customer = _t(spark, sf, "customer")
    wh.overwrite("customer_status", customer.withColumn("last_order_status", F.lit("NONE")), bucket_by=["c_custkey"])
    orders = _t(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderstatus", "o_orderdate", "o_orderkey"
    )
    wh.update_by_key("customer_status", orders, ["c_custkey"], {"last_order_status": "o_orderstatus"},
                     order_by=["o_orderdate", "o_orderkey"])
    return wh.read("customer_status")


def _versioned_orders(spark, sf):
    """All orders; tracked values are missing in some and hold separators and quotes in others."""
    return _t(spark, sf, "orders").withColumns({
        "o_orderstatus": F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")),
        "o_orderpriority": F.when(F.col("o_orderkey") % 5 == 0, 'a|b "c" \\ d').when(
            F.col("o_orderkey") % 5 != 1, F.col("o_orderpriority")),
    })


def q_upsert_partial_columns(spark, sf):
    """``customer``, then an upsert that carries the key and the segment alone, for known and new keys."""
    wh = Warehouse.scratch(spark, "partial")
    customer = _t(spark, sf, "customer")
    wh.upsert("customer", customer, ["c_custkey"])
    updates = customer.where("c_custkey % 2 = 0").select("c_custkey", F.lit("EVEN").alias("c_mktsegment")).union(
        customer.select(F.col("c_custkey") + 1_000_000, F.lit("NEW")))
    wh.upsert("customer", updates, ["c_custkey"])
    return wh.read("customer")


def q_version_changes(spark, sf):
    changed = version_changes(
        _versioned_orders(spark, sf), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderstatus", "o_orderpriority"], keep=[]
    )
    return changed.select("o_custkey", "o_orderkey", "o_orderdate", "version_hash", "previous_hash")


def q_duplicate_keys(spark, sf):
    return duplicate_keys(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_key_conflicts(spark, sf):
    return key_conflicts(_t(spark, sf, "lineitem"), "l_partkey", "l_suppkey")


# ----------------------------------------------------------------------------- run-log reports


def _events_as_runs(spark, sf):
    """Events as a run log: long error texts, and times cut to the day, so that a user's runs tie."""
    return _t(spark, sf, "events").withColumns({
        "props": F.concat("props", F.lit(" "), F.repeat(F.lit("trace "), (F.col("event_id") % 120).cast("int"))),
        "ts": F.date_trunc("day", "ts").cast("timestamp_ntz"),
    })


_RUN_COLUMNS = {"key": "user_id", "status": "event_type", "ts": "ts", "error": "props", "failed_value": "error", "tie": "event_id"}


def q_run_health_summary(spark, sf):
    return run_health(_events_as_runs(spark, sf), **_RUN_COLUMNS)


def q_latest_failure(spark, sf):
    return latest_failure(_events_as_runs(spark, sf), **_RUN_COLUMNS)


def q_health_by_customer(spark, sf):
    """Every customer (the registered keys) with the run statistics of its events; zero if none."""
    registered = _t(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    return run_health(_events_as_runs(spark, sf), **_RUN_COLUMNS, registered=registered)


def q_track_versions(spark, sf):
    """Latest order per customer since 1996 versus the customer's version history before it."""
    orders = _versioned_orders(spark, sf)
    cut = F.lit(VERSION_CUT).cast("timestamp_ntz")
    history = orders.where(F.col("o_orderdate") < cut).select(
        "o_custkey",
        fingerprint("o_orderstatus", "o_orderpriority").alias("version_hash"),
        F.col("o_orderdate").alias("recorded_at"),
        F.col("o_orderkey").alias("seq"),
    )
    incoming = latest_by_key(
        orders.where(F.col("o_orderdate") >= cut).select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority"),
        ["o_custkey"], ["o_orderdate", "o_orderkey"],
    ).select("o_custkey", "o_orderstatus", "o_orderpriority")
    return track_versions(history, incoming, ["o_custkey"], ["o_orderstatus", "o_orderpriority"],
                          order_by=["recorded_at", "seq"])


def q_failure_alerts(spark, sf):
    return failure_alerts(
        _events_as_runs(spark, sf), name="user_id", run_id="event_id", error="props", status="event_type", failed_value="error"
    )


# ----------------------------------------------------------------------------- sources and sinks


def q_csv_roundtrip(spark, sf):
    """Write ``orders`` as CSV with line breaks, quotes, empty and missing values in a text column, and read
    it back with type inference."""
    path = scratch_path(spark, "orders_csv")
    orders = _t(spark, sf, "orders").withColumn("o_orderpriority", F.when(
        F.col("o_orderkey") % 5 == 0, F.concat(F.col("o_orderpriority"), F.lit('\nsaid "urgent", then left'))).when(
        F.col("o_orderkey") % 5 == 1, "NA").when(F.col("o_orderkey") % 5 == 2, "null").otherwise(F.col("o_orderpriority")))
    orders.write.option("header", "true").option("escape", '"').csv(path)
    back = read_csv(spark, path, multiLine="true")
    return back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in orders.schema.fields])


def q_json_records(spark, sf):
    """Land ``customer`` as JSON lines with missing segments and read it back."""
    path = scratch_path(spark, "customer_json")
    customer = _t(spark, sf, "customer").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")))
    write_json_lines(customer, path)
    back = read_json(spark, path)
    return back.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"),
        "c_name",
        F.col("c_nationkey").cast("int").alias("c_nationkey"),
        F.col("c_acctbal").cast("double").alias("c_acctbal"),
        "c_mktsegment",
    )


def q_append_twice(spark, sf):
    wh = Warehouse.scratch(spark, "append")
    customer = _t(spark, sf, "customer")
    wh.append("customer_twice", customer)
    wh.append("customer_twice", customer)
    return wh.read("customer_twice")


def q_by_name_load(spark, sf):
    wh = Warehouse.scratch(spark, "byname")
    customer = _t(spark, sf, "customer")
    wh.append("customer_by_name", customer)
    # by name, in another order, with the segment absent
    wh.append("customer_by_name", customer.select("c_acctbal", "c_name", "c_nationkey", "c_custkey"))
    return wh.read("customer_by_name")


def q_overwrite_twice(spark, sf):
    wh = Warehouse.scratch(spark, "overwrite")
    customer = _t(spark, sf, "customer")
    wh.overwrite("customer_once", customer)
    wh.overwrite("customer_once", customer)
    return wh.read("customer_once")


# ----------------------------------------------------------------------------- schema


def _orders_spec(sf: str) -> LoadSpec:
    return LoadSpec(
        name="orders_feed",
        owner="analytics",
        source=SourceSpec(type="parquet", path=f"{sf.rstrip('/')}/orders.parquet", incremental_key="o_orderkey"),
        destination=DestinationSpec("raw", "orders"),
        quality=QualitySpec(True, [Check("orderkey_unique", "o_orderkey", "unique")]),
    )


def q_schema_report(spark, sf):
    """Load ``orders``; the first load stores the schema snapshot that is reported."""
    wh = Warehouse.scratch(spark, "schema")
    state = RunState(wh)
    _require(run_load(spark, _orders_spec(sf), wh, state=state))
    return state.stored_schema("orders_feed")


def _reshaped_orders(spark, sf):
    """Orders with the customer key as text and the priority under another name."""
    return (_t(spark, sf, "orders").withColumn("o_custkey", F.col("o_custkey").cast("string"))
            .withColumnRenamed("o_orderpriority", "o_urgency"))


def q_schema_drift(spark, sf):
    """Load ``orders``, then compare a reshaped feed with the stored snapshot."""
    wh = Warehouse.scratch(spark, "drift")
    state = RunState(wh)
    _require(run_load(spark, _orders_spec(sf), wh, state=state))
    return state.schema_drift("orders_feed", _reshaped_orders(spark, sf).schema)


def _run_log(state: RunState) -> DataFrame:
    return state.runs().select("status", "rows_extracted", "rows_loaded", "rows_without_key",
                               F.substring_index("error_message", "\n", 1).alias("error_message"))


def q_drift_blocked_load(spark, sf):
    """``orders``, then a reshaped feed of later orders: the run log of both."""
    wh = Warehouse.scratch(spark, "blocked")
    state = RunState(wh)
    _require(run_load(spark, _orders_spec(sf), wh, state=state))
    later = _reshaped_orders(spark, sf).withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000)
    run_load(spark, _orders_spec(sf), wh, source=later, state=state)
    return _run_log(state)


def q_forced_load(spark, sf):
    """``orders`` partly without a key, then forced without the priority: the table and what it lacks."""
    wh = Warehouse.scratch(spark, "forced")
    state = RunState(wh)
    orders = _t(spark, sf, "orders")
    keyed = orders.withColumn("o_orderkey", F.when(F.col("o_orderkey") % 8 != 0, F.col("o_orderkey")))
    _require(run_load(spark, _orders_spec(sf), wh, source=keyed, state=state))
    later = orders.drop("o_orderpriority").withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000)
    _require(run_load(spark, _orders_spec(sf), wh, source=later, state=state, force=True))
    counted = state.runs().select(F.sum("rows_without_key").alias("rows_without_key"))
    return wh.read("raw_orders").crossJoin(F.broadcast(counted))


# ----------------------------------------------------------------------------- SQL


def q_param_lookup(spark, sf):
    view = _view(spark, sf, "orders")
    return run_query(
        spark,
        f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM {view} "
        "WHERE o_custkey = ? ORDER BY o_orderkey",
        [899],
    )


def q_sql_passthrough(spark, sf):
    c, n, r = (_view(spark, sf, t) for t in ("customer", "nation", "region"))
    return run_query(
        spark,
        f"""
        WITH ranked AS (
          SELECT r.r_name, cu.c_custkey, cu.c_acctbal,
                 row_number() OVER (PARTITION BY r.r_name ORDER BY cu.c_acctbal DESC, cu.c_custkey) AS rk
          FROM {c} cu JOIN {n} na ON cu.c_nationkey = na.n_nationkey
                      JOIN {r} r ON na.n_regionkey = r.r_regionkey)
        SELECT r_name, CAST(rk AS BIGINT) AS rk, c_custkey, c_acctbal FROM ranked WHERE rk <= 3
        UNION ALL
        SELECT r_name, CAST(0 AS BIGINT) AS rk, CAST(NULL AS BIGINT) AS c_custkey, CAST(NULL AS DOUBLE) AS c_acctbal
        FROM {r}
        """,
    )


SEGMENT_YEARS_SQL = """
/* how each market segment orders over the years; semicolons in comments; do not end a statement */
DROP TABLE IF EXISTS segment_years;
CREATE TABLE segment_years AS
SELECT c.c_mktsegment AS segment, year(o.o_orderdate) AS order_year, count(*) AS n_orders, max(o.o_totalprice) AS top_price
FROM raw_orders o JOIN raw_customer c ON o.o_custkey = c.c_custkey  -- every customer has one segment
GROUP BY c.c_mktsegment, year(o.o_orderdate);
CREATE TABLE IF NOT EXISTS segment_years AS SELECT 'never; run' AS segment;
"""


def q_sql_transform(spark, sf):
    wh = Warehouse.scratch(spark, "transform")
    for name in ("orders", "customer"):
        wh.overwrite(f"raw_{name}", _t(spark, sf, name))
    run_sql_transform(wh, SEGMENT_YEARS_SQL)
    return wh.read("segment_years")


# ----------------------------------------------------------------------------- whole loads

USER_DAYS_SQL = """
CREATE OR REPLACE TABLE user_days AS
SELECT user_id, CAST(CAST(ts AS DATE) AS STRING) AS day, count(*) AS n_events, count(DISTINCT event_type) AS n_types,
       max(value) AS top_value
FROM raw_events
GROUP BY user_id, CAST(ts AS DATE)
"""


def events_spec(sf: str, transform: bool = False, mode: str = "append") -> LoadSpec:
    return LoadSpec(
        name="events_feed",
        owner="analytics",
        source=SourceSpec(type="parquet", path=f"{sf.rstrip('/')}/events.parquet", incremental_key="ts"),
        destination=DestinationSpec("raw", "events"),
        load_mode=mode,
        schedule="0 * * * *",
        quality=QualitySpec(
            enabled=True,
            checks=[
                Check("event_id_present", "event_id", "not_null"),
                Check("event_id_unique", "event_id", "unique"),
                Check("has_rows", None, "min_rows", 1),
            ],
        ),
        transform=TransformSpec(sql=USER_DAYS_SQL) if transform else None,
    )


def _runs_with_marks(state: RunState, name: str) -> DataFrame:
    runs = state.runs().where(F.col("pipeline_name") == name)
    marks = state.marks().where(F.col("pipeline_name") == name)
    return runs.join(marks.select("run_id", "max_value"), "run_id", "left").select(
        "status",
        "rows_extracted",
        "rows_loaded",
        F.col("max_value").cast("timestamp_ntz").alias("high_water_mark"),
    )


def _require(result: dict) -> None:
    if result["status"] != "success":
        raise RuntimeError(result["error_message"])


def q_incremental_two_runs(spark, sf):
    wh = Warehouse.scratch(spark, "incr")
    state = RunState(wh)
    spec = events_spec(sf)
    events = _t(spark, sf, "events")
    _require(run_load(spark, spec, wh, source=events.where(F.col("ts") <= F.lit(SPLIT).cast("timestamp_ntz")), state=state))
    _require(run_load(spark, spec, wh, state=state))  # the whole table again: only newer rows load
    return _runs_with_marks(state, spec.name)


def q_lineitem_load(spark, sf):
    """The largest table through two incremental loads with quality rules (split on ship date);
    returns the published table, which then holds every line once."""
    wh = Warehouse.scratch(spark, "lineitem")
    state = RunState(wh)
    spec = LoadSpec(
        name="lineitem_feed",
        owner="warehouse-team",
        source=SourceSpec(type="parquet", path=f"{sf.rstrip('/')}/lineitem.parquet", incremental_key="l_shipdate"),
        destination=DestinationSpec("raw", "lineitem"),
        quality=QualitySpec(True, [
            Check("order_present", "l_orderkey", "not_null"),
            Check("quantity_positive", "l_quantity", "greater_than"),
            Check("has_rows", None, "min_rows", 1),
        ]),
    )
    lineitem = _t(spark, sf, "lineitem")
    first = lineitem.where(F.col("l_shipdate") <= F.lit(LINEITEM_SPLIT).cast("timestamp_ntz"))
    _require(run_load(spark, spec, wh, source=first, state=state))
    _require(run_load(spark, spec, wh, state=state))
    return wh.read("raw_lineitem")


def q_load_partitions(spark, sf):
    """``events`` in two incremental loads into a load-partitioned table (each load published as
    its own partition, without copying); the table then holds every event once."""
    wh = Warehouse.scratch(spark, "loadparts")
    state = RunState(wh)
    base = events_spec(sf)
    spec = LoadSpec(base.name, base.owner, base.source, DestinationSpec("raw", "events", load_partitions=True),
                    quality=base.quality)
    events = _t(spark, sf, "events")
    _require(run_load(spark, spec, wh, source=events.where(F.col("ts") <= F.lit(SPLIT).cast("timestamp_ntz")), state=state))
    _require(run_load(spark, spec, wh, state=state))
    return wh.read("raw_events")


def q_stream_available_now(spark, sf):
    wh = Warehouse.scratch(spark, "stream")
    state = RunState(wh)
    spec = events_spec(sf)
    landing = scratch_path(spark, "landing")
    checkpoint = scratch_path(spark, "stream-checkpoint")
    events = _t(spark, sf, "events")
    events.where(F.col("ts") <= F.lit(SPLIT).cast("timestamp_ntz")).write.parquet(landing)
    stream_load(spark, spec, wh, landing, checkpoint, events.schema, state=state)
    events.write.mode("append").parquet(landing)  # second drop repeats the old rows
    stream_load(spark, spec, wh, landing, checkpoint, events.schema, state=state)
    return _runs_with_marks(state, spec.name)


def q_stream_split_backlog(spark, sf):
    """All events as a backlog of files, latest first, loaded one file a micro-batch."""
    wh = Warehouse.scratch(spark, "backlog")
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "stream-checkpoint")
    events = _t(spark, sf, "events")
    events.repartitionByRange(4, F.desc("ts")).write.parquet(landing)
    stream_load(spark, events_spec(sf), wh, landing, checkpoint, events.schema, max_files_per_batch=1)
    return wh.read("raw_events")


class _Rejected(Exception):
    """A load that was meant to fail did not."""


def _cut_off_stream(spark, sf, wh, unique_key=None):
    """A call that loads the larger part of ``events`` and is ended by a rule on the rest; then rows land again
    (without a unique key those that were loaded, with one all events) and a call without the rule finishes."""
    state = RunState(wh)
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "stream-checkpoint")
    events = _t(spark, sf, "events")
    late = F.col("ts") > F.lit(SPLIT).cast("timestamp_ntz")
    parts = sorted(((events.where(c).count(), i, events.where(c)) for i, c in enumerate((late, ~late))), reverse=True)
    parts[0][2].write.parquet(landing)
    files = len(spark.read.schema(events.schema).parquet(landing).inputFiles())  # the first micro-batch: these files
    parts[1][2].write.mode("append").parquet(landing)
    spec = events_spec(sf)
    spec.quality = QualitySpec(True, [Check("as_many_as_before", None, "min_rows", parts[0][0])])
    try:
        stream_load(spark, spec, wh, landing, checkpoint, events.schema, state=state, max_files_per_batch=files, unique_key=unique_key)
    except Exception as exc:  # noqa: BLE001 - Spark wraps the error of a micro-batch
        if "as_many_as_before" not in str(exc):
            raise
    else:
        raise _Rejected("the rule did not end the call")
    (events if unique_key else parts[0][2]).write.mode("append").parquet(landing)
    spec.quality = QualitySpec(False)
    stream_load(spark, spec, wh, landing, checkpoint, events.schema, state=state, max_files_per_batch=files, unique_key=unique_key)
    return wh.read("raw_events")


def q_stream_restart(spark, sf):
    """``events`` over a call that was cut off, then what had been loaded lands again: every event once."""
    return _cut_off_stream(spark, sf, Warehouse.scratch(spark, "restart"))


def q_stream_unique_key(spark, sf):
    """As ``stream_restart``, with all events landing again and streaming state that holds the keys seen."""
    return _cut_off_stream(spark, sf, Warehouse.scratch(spark, "unique"), unique_key=["event_id"])


def _table_spec(sf: str, table: str, mode: str = "append", checks=None) -> LoadSpec:
    return LoadSpec(
        name=f"{table}_feed",
        owner="warehouse-team",
        source=SourceSpec(type="parquet", path=f"{sf.rstrip('/')}/{table}.parquet"),
        destination=DestinationSpec("raw", table),
        load_mode=mode,
        schedule="@daily",
        quality=QualitySpec(bool(checks), checks or []),
    )


def q_run_all_loads(spark, sf):
    """Several loads run in name order; the failing one (last by name) is reported with its error."""
    wh = Warehouse.scratch(spark, "runall")
    specs = [
        _table_spec(sf, "orders", "overwrite", [Check("orderkey_unique", "o_orderkey", "unique")]),
        _table_spec(sf, "customer"),
        _table_spec(sf, "supplier", "overwrite"),
        LoadSpec("zz_balances_feed", "finance", SourceSpec("parquet", path=f"{sf.rstrip('/')}/customer.parquet"),
                 DestinationSpec("raw", "balances"),
                 quality=QualitySpec(True, [Check("acctbal_positive", "c_acctbal", "greater_than")])),
    ]
    run_all(spark, specs, wh)
    state = RunState(wh)
    loaded = state.runs().groupBy("pipeline_name").agg(F.sum("rows_loaded").alias("rows_loaded"))
    return state.health().join(loaded, "pipeline_name", "left").select(
        "pipeline_name", "owner", "load_mode", "status", "total_runs", "failures", "rows_loaded", "last_error"
    )


def q_end_to_end_load(spark, sf):
    wh = Warehouse.scratch(spark, "e2e")
    _require(run_load(spark, events_spec(sf, transform=True), wh))
    return wh.read("user_days")


TIDY_EVENTS = RowTable("tidy_events", {
    "event_id": "event_id", "user_id": "user_id", "ts": "CAST(ts AS TIMESTAMP_NTZ)", "event_type": "lower(trim(event_type))",
}, where="event_id IS NOT NULL AND ts IS NOT NULL AND user_id > 0")
USER_DAYS = GroupTable("user_days", {"user_id": "user_id", "day": "CAST(CAST(ts AS DATE) AS STRING)"}, {
    "n_events": Measure("count"), "n_types": Measure("count_distinct", "event_type"), "top_value": Measure("max", "value"),
    "cents": Measure("sum", "CAST(round(value * 100) AS BIGINT)"),
})


def _three_loads(spark, sf, wh, events, table, between=None):
    """``events`` in three incremental loads, each followed by a refresh of the derived table."""
    spec = events_spec(sf)
    spec.transform = TransformSpec(derived=[table])
    state = RunState(wh)
    for upto in ("2024-01-10", "2024-01-29", None):
        rows = events if upto is None else events.where(F.col("ts") < F.lit(upto).cast(events.schema["ts"].dataType))
        _require(run_load(spark, spec, wh, source=rows, state=state))
        if between is not None and upto is not None:
            between()
    return wh.read(table.target)


def q_derived_rows(spark, sf):
    """A tidy projection of untidy events that follows three loads, reading each of them once."""
    wh = Warehouse.scratch(spark, "derivedrows")
    return _three_loads(spark, sf, wh, _untidy_events(spark, sf), TIDY_EVENTS)


def q_derived_groups(spark, sf):
    """Users' days from partial aggregates of three loads, folded after each of the first two."""
    wh = Warehouse.scratch(spark, "derivedgroups")
    return _three_loads(spark, sf, wh, _t(spark, sf, "events"), USER_DAYS, between=lambda: fold(wh, USER_DAYS))


def q_late_rows_load(spark, sf):
    """Every seventh event of the first half comes late, with the second half; all events land again after that.  The
    table, which holds every event once, and how many rows the run log counts as late."""
    wh = Warehouse.scratch(spark, "late")
    state = RunState(wh)
    spec = events_spec(sf)
    spec.source.look_back, spec.source.unique_key, spec.quality = "31 days", ["event_id"], QualitySpec(False)
    events = _t(spark, sf, "events")
    in_time = (F.col("ts") <= F.lit(SPLIT).cast("timestamp_ntz")) & (F.col("event_id") % 7 != 0)
    for rows in (events.where(in_time), events, events):
        _require(run_load(spark, spec, wh, source=rows, state=state))
    late = state.runs().select(F.sum("rows_late").alias("rows_late"))
    return wh.read("raw_events").crossJoin(F.broadcast(late))


def q_zone_map_loads(spark, sf):
    """Events landed as files of consecutive times, the second half after a load of the first; a third load finds nothing
    new.  The table, and how many files a fourth load would open."""
    wh = Warehouse.scratch(spark, "zones")
    state = RunState(wh)
    folder = scratch_path(spark, "landing")
    spec = events_spec(sf)
    spec.source = SourceSpec("parquet", folder, incremental_key="ts", zone_map=True)
    spec.quality = QualitySpec(False)
    events = _t(spark, sf, "events")
    for rows in (F.col("ts") <= F.lit(SPLIT).cast("timestamp_ntz"), F.col("ts") > F.lit(SPLIT).cast("timestamp_ntz")):
        events.where(rows).repartitionByRange(8, "ts").write.mode("append").parquet(folder)
        _require(run_load(spark, spec, wh, state=state))
    _require(run_load(spark, spec, wh, state=state))
    last = landed_files(wh, spec.name, spec.source, state.get_mark(spec.name, "ts"))
    return wh.read("raw_events").withColumn("files_left_to_open", F.lit(len(last.opened)))


def q_keyed_small_updates(spark, sf):
    """``customer`` as a keyed table with deltas: the latest order status by update, a segment by partial upsert for
    known and new keys, absent customers by insert, then one delta of all."""
    wh = Warehouse.scratch(spark, "keyed")
    customer = _t(spark, sf, "customer")
    whole = customer.withColumn("last_order_status", F.lit("NONE"))
    table = KeyedTable(wh, "customer_status", ["c_custkey"], whole.schema)
    table.upsert(whole)
    orders = _t(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus", "o_orderdate", "o_orderkey")
    table.update_by_key(orders, {"last_order_status": "o_orderstatus"}, order_by=["o_orderdate", "o_orderkey"])
    table.upsert(customer.where("c_custkey % 2 = 0").select("c_custkey", F.lit("EVEN").alias("c_mktsegment")).union(
        customer.select(F.col("c_custkey") + 1_000_000, F.lit("NEW"))))
    absent = customer.withColumns({"c_custkey": F.col("c_custkey") + 2_000_000, "last_order_status": F.lit("ABSENT")})
    table.insert_if_absent(whole.unionByName(absent), ["c_name"])
    table.merge_deltas()
    return table.read()


def q_run_log_of_failures(spark, sf):
    """A load of ``customer``, one of a missing file and one by a column that is not there: what the log, the registry
    and the health report say of them."""
    wh = Warehouse.scratch(spark, "failures")
    state = RunState(wh)
    specs = [
        LoadSpec("a_missing", "finance", SourceSpec("csv", path=scratch_path(spark, "nothing.csv")), DestinationSpec("raw", "missing")),
        LoadSpec("b_keyless", "finance", SourceSpec("parquet", path=f"{sf.rstrip('/')}/customer.parquet", incremental_key="no_such_key"),
                 DestinationSpec("raw", "keyless")),
        _table_spec(sf, "customer"),
    ]
    for spec in specs:
        run_load(spark, spec, wh, state=state)
    runs = state.runs().select(
        "pipeline_name", "status", "rows_loaded",
        F.when(F.col("error_message").startswith("CSV"), F.substring_index("error_message", ":", 1)).otherwise(F.col("error_message")).alias("error"),
        F.col("run_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$").alias("has_run_id"),
        (F.round("execution_time_seconds", 2) == F.col("execution_time_seconds")).alias("rounded"),
        (F.abs(F.unix_timestamp(F.col("run_timestamp").cast("timestamp")) - F.unix_timestamp(F.to_utc_timestamp(F.now(), F.current_timezone())))
         < 86_400).alias("in_utc"))
    registered = state.pipelines().select("pipeline_name", "owner", "last_status", (F.col("created_at") < F.col("last_run_at")).alias("created_before"))
    return runs.join(registered, "pipeline_name").join(state.health().select("pipeline_name", "indicator"), "pipeline_name")


def q_conflicting_loads(spark, sf):
    """Two loads that name one destination are refused; then the first claimant and another load run."""
    wh = Warehouse.scratch(spark, "conflicts")
    orders, customer = _table_spec(sf, "orders"), _table_spec(sf, "customer")
    second = LoadSpec("z_orders", "finance", orders.source, orders.destination)
    specs = [second, orders, customer]
    try:
        run_all(spark, specs, wh)
    except ValueError:
        refused = wh.exists("raw_orders")  # false: nothing ran
    run_all(spark, [orders, customer], wh)
    loaded = RunState(wh).runs().select("pipeline_name", "rows_loaded")
    conflicts = destination_conflicts(spark, specs)
    return conflicts.join(loaded, conflicts["first_claimant"] == loaded["pipeline_name"]).select(
        "destination", "n_owners", "first_claimant", "rows_loaded", F.lit(refused).alias("loaded_before"))


QUOTED = "it's \"fine\"; DROP TABLE notes -- \\"


def q_param_write(spark, sf):
    """Rows written by SQL with bound parameters: quotes in a value are harmless."""
    wh = Warehouse.scratch(spark, "params")
    wh.append("orders_in", _t(spark, sf, "orders"))
    wh.ensure_table("notes", _t(spark, sf, "orders").select("o_orderkey", F.lit("").alias("note")).schema)
    wh.execute("INSERT INTO notes SELECT o_orderkey, :note FROM orders_in WHERE o_orderstatus = :status", {"note": QUOTED, "status": "F"})
    return wh.read("notes")


def q_latest_event(spark, sf):
    """The last row of a log by time: one ``TakeOrderedAndProject``."""
    return run_query(spark, f"SELECT event_id, ts, user_id, event_type, value, props FROM {_view(spark, sf, 'events')} "
                            "ORDER BY ts DESC, event_id DESC LIMIT 1")


def q_audited_events(spark, sf):
    """Clean events with the audit column: one time for all rows, that of the query."""
    clean = clean_events_op(_untidy_events(spark, sf), ts="ts", audit=True)
    return clean.withColumn("stamped", F.abs(F.unix_timestamp(F.col("processed_at").cast("timestamp")) - F.unix_timestamp(F.now())) < 86_400).drop("processed_at")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_orders": q_clean_orders,
    "clean_events": q_clean_events,
    "incremental_filter": q_incremental_filter,
    "hwm_per_key": q_hwm_per_key,
    "dq_report": q_dq_report,
    "upsert_latest": q_upsert_latest,
    "run_health_summary": q_run_health_summary,
    "latest_failure": q_latest_failure,
    "key_conflicts": q_key_conflicts,
    "duplicate_keys": q_duplicate_keys,
    "version_changes": q_version_changes,
    "failure_alerts": q_failure_alerts,
    "health_by_customer": q_health_by_customer,
    "track_versions": q_track_versions,
    "csv_roundtrip": q_csv_roundtrip,
    "json_records": q_json_records,
    "append_twice": q_append_twice,
    "by_name_load": q_by_name_load,
    "insert_if_absent": q_insert_if_absent,
    "update_by_key": q_update_by_key,
    "schema_report": q_schema_report,
    "schema_drift": q_schema_drift,
    "dq_min_rows": q_dq_min_rows,
    "param_lookup": q_param_lookup,
    "sql_passthrough": q_sql_passthrough,
    "incremental_two_runs": q_incremental_two_runs,
    "overwrite_twice": q_overwrite_twice,
    "sql_transform": q_sql_transform,
    "lineitem_load": q_lineitem_load,
    "load_partitions": q_load_partitions,
    "stream_available_now": q_stream_available_now,
    "stream_split_backlog": q_stream_split_backlog,
    "stream_restart": q_stream_restart,
    "stream_unique_key": q_stream_unique_key,
    "derived_rows": q_derived_rows,
    "derived_groups": q_derived_groups,
    "late_rows_load": q_late_rows_load,
    "zone_map_loads": q_zone_map_loads,
    "keyed_small_updates": q_keyed_small_updates,
    "run_log_of_failures": q_run_log_of_failures,
    "conflicting_loads": q_conflicting_loads,
    "param_write": q_param_write,
    "latest_event": q_latest_event,
    "audited_events": q_audited_events,
    "drift_blocked_load": q_drift_blocked_load,
    "forced_load": q_forced_load,
    "upsert_partial_columns": q_upsert_partial_columns,
    "run_all_loads": q_run_all_loads,
    "end_to_end_load": q_end_to_end_load,
}
