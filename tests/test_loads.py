"""Whole loads: append/overwrite, high-water marks, drift gates, failure handling."""

import pytest
from pyspark.sql import functions as F

from flowtable.operators.quality import Check
from flowtable.plans.runner import run_load
from flowtable.plans.spec import DestinationSpec, LoadSpec, QualitySpec, SourceSpec, TransformSpec
from flowtable.plans.state import RunState


def spec(path, name="tickets", mode="append", key=None, checks=None, transform=None):
    return LoadSpec(
        name=name,
        owner="harbour desk",
        source=SourceSpec(type="csv", path=path, incremental_key=key),
        destination=DestinationSpec("raw", name),
        load_mode=mode,
        schedule="30 2 * * 1",
        quality=QualitySpec(enabled=bool(checks), checks=checks or []),
        transform=transform,
    )


ORDERS = "ticket,fee\n71,4\n72,9\n"


def test_success_result_and_counts(spark, wh, write_csv):
    res = run_load(spark, spec(write_csv("o.csv", ORDERS)), wh)
    assert res["status"] == "success"
    assert res["rows_extracted"] == 2 and res["rows_loaded"] == 2
    assert res["execution_time_seconds"] >= 0
    assert wh.read("raw_tickets").count() == 2


def test_run_record_and_registry(spark, wh, write_csv):
    state = RunState(wh)
    run_load(spark, spec(write_csv("o.csv", ORDERS)), wh, state=state)
    runs = state.runs().collect()
    assert len(runs) == 1
    assert runs[0].status == "SUCCESS" and runs[0].rows_loaded == 2 and runs[0].error_message is None
    reg = state.pipelines().collect()
    assert len(reg) == 1 and reg[0].last_status == "SUCCESS" and reg[0].owner == "harbour desk"


def test_append_accumulates_and_overwrite_replaces(spark, wh, write_csv):
    path = write_csv("o.csv", ORDERS)
    for _ in range(2):
        run_load(spark, spec(path, name="app"), wh)
        run_load(spark, spec(path, name="ovr", mode="overwrite"), wh)
    assert wh.read("raw_app").count() == 4
    assert wh.read("raw_ovr").count() == 2


def test_missing_source_is_logged_failed_not_raised(spark, wh, tmp_path):
    state = RunState(wh)
    res = run_load(spark, spec(str(tmp_path / "missing.csv")), wh, state=state)
    assert res["status"] == "failed" and "missing.csv" in res["error_message"]
    runs = state.runs().collect()
    assert len(runs) == 1 and runs[0].status == "FAILED" and runs[0].error_message


def test_quality_failure_blocks_the_load(spark, wh, write_csv):
    path = write_csv("c.csv", "berth,vessel\n,Sula\nB7,Petrel\n")
    checks = [Check("berth_known", "berth", "not_null")]
    state = RunState(wh)
    alerts = []
    res = run_load(spark, spec(path, name="berths", checks=checks), wh, state=state, on_failure=alerts.append)
    assert res["status"] == "failed" and "berth_known" in res["error_message"]
    assert not wh.exists("raw_berths")
    assert state.pipelines().first().last_status == "FAILED"
    assert alerts and alerts[0].startswith("*Pipeline Failed* ✗\n*Pipeline:* `berths`")


def test_unique_check_runs_on_staged_rows(spark, wh, write_csv):
    path = write_csv("d.csv", "ticket,fee\n5,1\n5,2\n6,3\n")
    res = run_load(spark, spec(path, checks=[Check("u", "ticket", "unique")]), wh)
    assert res["status"] == "failed" and "1 duplicate" in res["error_message"]


# --- high-water marks --------------------------------------------------------------------


def test_first_run_stores_mark(spark, wh, write_csv):
    state = RunState(wh)
    path = write_csv("m.csv", "call,arrived\n11,2031-07-04\n12,2031-07-09\n13,2031-07-16\n")
    run_load(spark, spec(path, key="arrived"), wh, state=state)
    assert state.get_mark("tickets", "arrived") == "2031-07-16"


def test_mark_advances_and_only_new_rows_load(spark, wh, write_csv):
    state = RunState(wh)
    path = write_csv("m.csv", "call,arrived\n11,2031-07-04\n12,2031-07-09\n")
    assert run_load(spark, spec(path, key="arrived"), wh, state=state)["rows_loaded"] == 2
    assert run_load(spark, spec(path, key="arrived"), wh, state=state)["rows_loaded"] == 0
    path = write_csv("m.csv", "call,arrived\n11,2031-07-04\n12,2031-07-09\n13,2031-08-02\n")
    assert run_load(spark, spec(path, key="arrived"), wh, state=state)["rows_loaded"] == 1
    assert state.get_mark("tickets", "arrived") == "2031-08-02"
    assert wh.read("raw_tickets").count() == 3


def test_no_key_loads_everything_each_run(spark, wh, write_csv):
    path = write_csv("m.csv", "call,arrived\n11,2031-07-04\n12,2031-07-09\n")
    assert run_load(spark, spec(path), wh)["rows_loaded"] == 2
    assert run_load(spark, spec(path), wh)["rows_loaded"] == 2


def test_missing_key_column_fails_naming_it(spark, wh, write_csv):
    path = write_csv("m.csv", ORDERS)
    res = run_load(spark, spec(path, key="tide"), wh)
    assert res["status"] == "failed" and "tide" in res["error_message"]


def test_numeric_key_compares_as_number(spark, wh, write_csv):
    state = RunState(wh)
    run_load(spark, spec(write_csv("n.csv", "id,v\n9,a\n10,b\n"), key="id"), wh, state=state)
    assert state.get_mark("tickets", "id") == "10"
    res = run_load(spark, spec(write_csv("n.csv", "id,v\n9,a\n10,b\n11,c\n"), key="id"), wh, state=state)
    assert res["rows_loaded"] == 1


def test_overwrite_with_nothing_new_keeps_table(spark, wh, write_csv):
    path = write_csv("m.csv", "call,arrived\n11,2031-07-04\n")
    run_load(spark, spec(path, mode="overwrite", key="arrived"), wh)
    run_load(spark, spec(path, mode="overwrite", key="arrived"), wh)
    assert wh.read("raw_tickets").count() == 1


# --- schema drift ------------------------------------------------------------------------

CREW = "badge,sailor,port,joined\nK1,Ines,Vigo,2030-11-01 08:30:00\nK2,Olav,Bergen,2030-11-07 17:45:00\n"


def test_removed_column_fails(spark, wh, write_csv):
    run_load(spark, spec(write_csv("c.csv", CREW), name="crew"), wh)
    res = run_load(spark, spec(write_csv("c.csv", "badge,sailor,joined\nK3,Ravi,2030-12-01 00:15:00\n"), name="crew"), wh)
    assert res["status"] == "failed" and "port" in res["error_message"]


def test_added_column_fails(spark, wh, write_csv):
    run_load(spark, spec(write_csv("c.csv", CREW), name="crew"), wh)
    res = run_load(spark, spec(write_csv("c.csv", CREW.replace("joined\n", "joined,radio\n").replace(":30:00\n", ":30:00,ch16\n").replace(":45:00\n", ":45:00,ch9\n")), name="crew"), wh)
    assert res["status"] == "failed" and "radio" in res["error_message"]


def test_retyped_column_fails(spark, wh, write_csv):
    run_load(spark, spec(write_csv("a.csv", "buoy,depth\n1,5\n"), name="depths"), wh)
    res = run_load(spark, spec(write_csv("a.csv", "buoy,depth\n2,deep\n"), name="depths"), wh)
    assert res["status"] == "failed" and "depth" in res["error_message"] and "type changed" in res["error_message"]


def test_force_bypasses_drift_and_fills_nulls(spark, wh, write_csv):
    state = RunState(wh)
    run_load(spark, spec(write_csv("c.csv", CREW), name="crew"), wh, state=state)
    res = run_load(spark, spec(write_csv("c.csv", "badge,sailor,joined\nK3,Ravi,2030-12-01 00:15:00\n"), name="crew"),
                   wh, force=True, state=state)
    assert res["status"] == "success"
    rows = wh.read("raw_crew").where("badge = 'K3'").collect()
    assert rows[0].port is None
    stored = {r.column_name for r in state.stored_schema("crew").collect()}
    assert stored == {"badge", "sailor", "joined"}


# --- transform ---------------------------------------------------------------------------


def test_transform_rebuilds_derived_table(spark, wh, write_csv):
    path = write_csv("s.csv", "haul,kilos,landed\n1,10.5,yes\n2,0,yes\n3,7,no\n")
    sql = "CREATE OR REPLACE TABLE by_landing AS SELECT landed, sum(kilos) AS kilos, count(*) AS hauls FROM raw_hauls GROUP BY landed"
    t = TransformSpec(sql=sql)
    for _ in range(2):
        assert run_load(spark, spec(path, name="hauls", mode="overwrite", transform=t), wh)["status"] == "success"
    rows = wh.read("by_landing").collect()
    assert {(r.landed, r.kilos, r.hauls) for r in rows} == {("yes", 10.5, 2), ("no", 7.0, 1)}


def test_transform_missing_file_fails(spark, wh, write_csv, tmp_path):
    t = TransformSpec(sql=str(tmp_path / "nope.sql"))
    res = run_load(spark, spec(write_csv("o.csv", ORDERS), transform=t), wh)
    assert res["status"] == "failed" and "nope.sql" in res["error_message"]
    assert res["rows_loaded"] == 2  # rows were published before the transform failed


def test_parquet_source_filter_reaches_scan(spark, wh):
    from flowtable.operators.incremental import incremental_filter

    df = incremental_filter(spark.read.parquet("/root/testdata/sf0.001/events.parquet"), "ts", "2024-01-15 00:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan
    assert F is not None


def test_run_all_checks_conflicts_then_runs_in_name_order(spark, wh, write_csv):
    import pytest

    from flowtable.plans.runner import run_all

    path = write_csv("o.csv", ORDERS)
    bad = write_csv("bad.csv", "ticket,fee\n1,-5\n")
    with pytest.raises(ValueError, match="raw_dup"):
        run_all(spark, [spec(path, name="dup"), LoadSpec("dup2", "x", SourceSpec("csv", path=path), DestinationSpec("raw", "dup"))], wh)
    specs = [spec(path, name="c_last"), spec(bad, name="b_bad", checks=[Check("pos", "fee", "greater_than")]), spec(path, name="a_first")]
    results = run_all(spark, specs, wh)
    assert [r["pipeline_name"] for r in results] == ["a_first", "b_bad"]
    assert results[-1]["status"] == "failed"
    health = {r.pipeline_name: r for r in RunState(wh).health().collect()}
    assert health["a_first"].indicator == "✓" and health["b_bad"].indicator == "✗"
    assert "c_last" not in health


def test_empty_increment_with_quality_rules(spark, wh, write_csv):
    path = write_csv("m.csv", "call,arrived\n11,2031-07-04\n12,2031-07-09\n")
    checks = [Check("id", "call", "not_null"), Check("u", "call", "unique")]
    for mode in ("append", "overwrite"):
        s = spec(path, name=f"empty_{mode}", mode=mode, key="arrived", checks=checks)
        assert run_load(spark, s, wh)["rows_loaded"] == 2
        res = run_load(spark, s, wh)
        assert res["status"] == "success" and res["rows_loaded"] == 0
        assert wh.read(f"raw_empty_{mode}").count() == 2


def test_partitioned_source_prunes_partitions_below_the_mark(spark, wh):
    from flowtable.operators.incremental import incremental_filter
    from flowtable.session import scratch_path

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    path = scratch_path(spark, "events_by_day")
    events.withColumn("dt", F.to_date("ts")).write.partitionBy("dt").parquet(path)
    landed = spark.read.parquet(path)
    mark = "2024-01-20 12:00:00"
    pruned = incremental_filter(landed, "ts", mark, partition_column="dt")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "dt#" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert pruned.count() == events.where(F.col("ts") > F.lit(mark).cast("timestamp_ntz")).count()
    # the same through a whole load
    state = RunState(wh)
    s = LoadSpec("by_day", "o", SourceSpec("parquet", path=path, incremental_key="ts", partition_column="dt"),
                 DestinationSpec("raw", "by_day"))
    first = run_load(spark, s, wh, source=landed.where(F.col("ts") <= F.lit(mark).cast("timestamp_ntz")), state=state)
    second = run_load(spark, s, wh, state=state)
    assert first["rows_loaded"] + second["rows_loaded"] == events.count()


def test_mark_never_moves_backwards(spark, wh):
    state = RunState(wh)
    s = LoadSpec("back", "o", SourceSpec("parquet", path="/unused", incremental_key="k"), DestinationSpec("raw", "back"))
    newer = spark.createDataFrame([(10, "a"), (12, "b")], "k int, v string")
    older = spark.createDataFrame([(5, "late"), (11, "c")], "k int, v string")
    assert run_load(spark, s, wh, source=newer, state=state)["rows_loaded"] == 2
    assert state.get_mark("back", "k") == "12"
    res = run_load(spark, s, wh, source=older, state=state)
    assert res["rows_loaded"] == 0  # both rows are at or below the mark: late rows are not loaded
    assert state.get_mark("back", "k") == "12"


def test_failure_callback_errors_do_not_hide_the_load_error(spark, wh, tmp_path):
    def broken(_msg):
        raise RuntimeError("webhook down")

    res = run_load(spark, spec(str(tmp_path / "gone.csv")), wh, on_failure=broken)
    assert res["status"] == "failed" and "gone.csv" in res["error_message"]
    assert "*Run ID:* `" + res["run_id"] + "`" in __import__("flowtable.operators.runlog", fromlist=["x"]).format_alert(
        "p", res["run_id"], res["error_message"])


def test_run_all_rejects_duplicate_names(spark, wh, write_csv):
    import pytest

    from flowtable.plans.runner import run_all

    path = write_csv("o.csv", ORDERS)
    with pytest.raises(ValueError, match="Duplicate pipeline names: same"):
        run_all(spark, [spec(path, name="same"), LoadSpec("same", "x", SourceSpec("csv", path=path), DestinationSpec("raw", "other"))], wh)


def test_api_source_reads_landed_json_arrays(spark, wh, tmp_path):
    landing = tmp_path / "api"
    landing.mkdir()
    (landing / "page1.json").write_text('[{"id": 1, "name": "a", "updated": "2026-03-01"}, {"id": 2, "name": "b", "updated": "2026-03-02"}]')
    (landing / "page2.json").write_text('[{"id": 3, "name": "c", "updated": "2026-03-03", "extra": {"k": 1}}]')
    state = RunState(wh)
    s = LoadSpec("api_feed", "o", SourceSpec("api", endpoint=str(landing), incremental_key="id"), DestinationSpec("raw", "api"))
    res = run_load(spark, s, wh, state=state)
    assert res["status"] == "success" and res["rows_loaded"] == 3
    assert state.get_mark("api_feed", "id") == "3"
    assert set(wh.read("raw_api").columns) == {"id", "name", "updated", "extra"}


def test_spec_from_parsed_document(spark, wh, write_csv):
    path = write_csv("hauls.csv", "haul,species,kilos,day\n1,cod,12.5,2031-01-04\n2,hake,0,2031-01-05\n3,cod,7,2031-01-06\n")
    doc = {
        "pipeline_name": "hauls", "owner": "fish market",
        "source": {"type": "csv", "path": path, "incremental_key": "day"},
        "destination": {"schema": "quay", "table": "hauls"},
        "schedule": {"cron": "15 4 * * *"}, "load_mode": "overwrite",
        "runtime_parameters": {"retries": 2},
        "quality_checks": {"enabled": True, "checks": [{"name": "kilos_ok", "column": "kilos", "rule": "greater_than", "value": -1}]},
        "transform": {"sql": "CREATE OR REPLACE TABLE species AS SELECT species, max(kilos) AS best FROM quay_hauls GROUP BY species"},
        "notify": {"on_failure": True},
    }
    s = LoadSpec.from_dict(doc)
    assert s.destination.physical == "quay_hauls" and s.schedule == "15 4 * * *" and s.notify_on_failure
    assert s.quality.checks[0].value == -1 and s.runtime_parameters == {"retries": 2}
    assert run_load(spark, s, wh)["rows_loaded"] == 3
    assert {(r.species, r.best) for r in wh.read("species").collect()} == {("cod", 12.5), ("hake", 0.0)}
    quiet = LoadSpec.from_dict({**doc, "notify": {}, "source": {"type": "csv", "path": path + ".missing"}})
    calls = []
    assert run_load(spark, quiet, wh, on_failure=calls.append)["status"] == "failed" and calls == []


def test_load_partitions_publish_each_load_without_a_copy(spark, wh):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    split = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    state = RunState(wh)
    dest = DestinationSpec("raw", "events_by_load", load_partitions=True)
    s = LoadSpec("ev_parts", "o", SourceSpec("parquet", path="/root/testdata/sf0.001/events.parquet", incremental_key="ts"),
                 dest, quality=QualitySpec(True, [Check("id", "event_id", "not_null")]))
    first = run_load(spark, s, wh, source=events.where(F.col("ts") <= split), state=state)
    second = run_load(spark, s, wh, state=state)
    assert first["status"] == second["status"] == "success"
    assert "_load_id" not in wh.read("raw_events_by_load").columns
    table = wh.read("raw_events_by_load", load_id=True)
    assert table.count() == events.count()
    loads = {r["_load_id"]: r["n"] for r in table.groupBy("_load_id").agg(F.count("*").alias("n")).collect()}
    assert loads == {first["run_id"]: first["rows_loaded"], second["run_id"]: second["rows_loaded"]}
    # the published files are the ones the load wrote: nothing was copied into the table folder
    assert all("/loads/" in f for f in table.inputFiles())
    # a failed gate leaves no partition behind
    bad = LoadSpec("ev_parts_bad", "o", SourceSpec("parquet", path="/unused"), DestinationSpec("raw", "bad_by_load", load_partitions=True),
                   quality=QualitySpec(True, [Check("few", None, "min_rows", 10**9)]))
    assert run_load(spark, bad, wh, source=events, state=state)["status"] == "failed"
    assert not wh.exists("raw_bad_by_load")


def test_csv_later_runs_read_with_the_stored_types(spark, wh, write_csv):
    from flowtable.plans.runner import _read_for_load

    state = RunState(wh)
    path = write_csv("p.csv", "id,amount,day\n1,5,2026-03-01\n2,7,2026-03-02\n")
    s = spec(path, name="pinned", key="day")
    first_df, pinned = _read_for_load(spark, s, state)
    assert not pinned  # nothing stored yet: types are inferred
    assert run_load(spark, s, wh, state=state)["rows_loaded"] == 2
    write_csv("p.csv", "id,amount,day\n1,5,2026-03-01\n2,7,2026-03-02\n3,9,2026-03-05\n")
    df, pinned = _read_for_load(spark, s, state)
    assert pinned and df.schema == first_df.schema
    res = run_load(spark, s, wh, state=state)
    assert res["status"] == "success" and res["rows_loaded"] == 1


def test_csv_value_that_breaks_its_stored_type_reports_drift(spark, wh, write_csv):
    state = RunState(wh)
    path = write_csv("p.csv", "id,amount\n1,5\n")
    run_load(spark, spec(path, name="retype"), wh, state=state)
    write_csv("p.csv", "id,amount\n2,abc\n")
    res = run_load(spark, spec(path, name="retype"), wh, state=state)
    assert res["status"] == "failed"
    assert "Column 'amount' type changed: int → string" in res["error_message"]
    assert wh.read("raw_retype").count() == 1


def test_zone_aware_mark_survives_a_session_time_zone_change(spark, wh):
    state = RunState(wh)
    s = LoadSpec("tz", "o", SourceSpec("parquet", path="/unused", incremental_key="t"), DestinationSpec("raw", "tz"))
    rows = spark.createDataFrame([("2026-03-01T10:00:00Z",), ("2026-03-01T12:00:00Z",)], "s string").select(
        F.col("s").cast("timestamp").alias("t"))
    run_load(spark, s, wh, source=rows, state=state)
    mark = state.get_mark("tz", "t")
    assert mark.endswith("Z") or mark.endswith("+00:00")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        later = spark.createDataFrame([("2026-03-01T12:00:00Z",), ("2026-03-01T12:30:00Z",)], "s string").select(
            F.col("s").cast("timestamp").alias("t"))
        assert run_load(spark, s, wh, source=later, state=state)["rows_loaded"] == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_drifted_load_writes_no_file(spark, wh, write_csv):
    import glob

    checks = [Check("known", "badge", "not_null")]
    run_load(spark, spec(write_csv("c.csv", CREW), name="crew", checks=checks), wh)
    files = sorted(glob.glob(wh.root.replace("file:", "") + "/raw_crew/**", recursive=True))
    path = write_csv("c.csv", "badge,sailor\n,Ravi\n")
    res = run_load(spark, spec(path, name="crew", checks=checks), wh)
    assert "known" in res["error_message"] and res["rows_extracted"] == 1  # the quality failure is reported first
    path = write_csv("c.csv", "badge,sailor\nK4,Ravi\n")
    assert "drift" in run_load(spark, spec(path, name="crew", checks=checks), wh)["error_message"].lower()
    assert sorted(glob.glob(wh.root.replace("file:", "") + "/raw_crew/**", recursive=True)) == files


def test_rows_without_a_key_are_counted_and_never_loaded(spark, wh):
    state = RunState(wh)
    s = LoadSpec("nulls", "o", SourceSpec("parquet", path="/unused", incremental_key="k"), DestinationSpec("raw", "nulls"))
    for rows, loaded in (([(1, "a"), (None, "b"), (2, "c")], 2), ([(2, "c"), (3, "d"), (None, "e"), (None, "f")], 1)):
        res = run_load(spark, s, wh, source=spark.createDataFrame(rows, "k int, v string"), state=state)
        assert (res["rows_loaded"], res["rows_without_key"]) == (loaded, sum(k is None for k, _ in rows))
    assert sorted(r.k for r in wh.read("raw_nulls").collect()) == [1, 2, 3]
    assert sorted(r.rows_without_key for r in state.runs().collect()) == [1, 2]


def test_a_run_repeated_after_its_state_was_lost_loads_nothing_twice(spark, wh, monkeypatch):
    s = LoadSpec("lost", "o", SourceSpec("parquet", path="/unused", incremental_key="k"), DestinationSpec("raw", "lost"))
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    state = RunState(wh)
    with monkeypatch.context() as m:
        m.setattr(RunState, "_write", lambda self, rows: (_ for _ in ()).throw(OSError("disk gone")))
        res = run_load(spark, s, wh, source=rows, state=state, run_id="r1")
    assert res["status"] == "failed" and "disk gone" in res["error_message"]
    res = run_load(spark, s, wh, source=rows, state=state, run_id="r1")
    assert (res["status"], res["rows_loaded"]) == ("success", 2)
    assert wh.read("raw_lost").count() == 2 and state.get_mark("lost", "k") == "2"


def test_missing_metrics_are_counted_in_the_written_files(spark, wh, monkeypatch):
    monkeypatch.setattr("flowtable.plans.runner.observed", lambda obs: None)
    monkeypatch.setattr("flowtable.operators.sinks.observed", lambda obs: None)
    state = RunState(wh)
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    for mode in ("append", "overwrite"):
        s = LoadSpec(f"m_{mode}", "o", SourceSpec("parquet", path="/unused", incremental_key="k"), DestinationSpec("raw", f"m_{mode}"),
                     load_mode=mode, quality=QualitySpec(True, [Check("v", "v", "not_null"), Check("few", None, "min_rows", 2)]))
        res = run_load(spark, s, wh, source=rows, state=state)
        assert (res["status"], res["rows_loaded"], res["rows_without_key"]) == ("success", 2, 1)
        assert state.get_mark(f"m_{mode}", "k") == "2" and wh.read(f"raw_m_{mode}").count() == 2
    assert wh.append("plain", rows) == 3 and wh.overwrite("plain", rows) == 3


def test_drift_lines_follow_column_order(spark, wh, write_csv):
    run_load(spark, spec(write_csv("c.csv", CREW), name="order"), wh)
    changed = "z_new,sailor,badge,a_new\nx,Ines,1,y\n"  # port + joined removed, badge retyped
    res = run_load(spark, spec(write_csv("c.csv", changed), name="order"), wh)
    lines = [l.strip() for l in res["error_message"].splitlines()[1:]]
    assert lines == [
        "- Column 'port' was removed from source",
        "- Column 'joined' was removed from source",
        "- New column 'z_new' not in stored schema",
        "- Column 'badge' type changed: string → int",
        "- New column 'a_new' not in stored schema",
    ]


def test_version_is_recorded_even_when_the_source_is_missing(spark, wh, tmp_path):
    state = RunState(wh)
    res = run_load(spark, spec(str(tmp_path / "absent.csv"), name="ver"), wh, state=state)
    assert res["status"] == "failed"
    assert state.versions().where("pipeline_name = 'ver'").count() == 1
    run_load(spark, spec(str(tmp_path / "absent.csv"), name="ver"), wh, state=state)
    assert state.versions().where("pipeline_name = 'ver'").count() == 1  # unchanged spec: no new version


def test_force_with_a_new_column_set_into_a_new_table(spark, wh, write_csv):
    run_load(spark, spec(write_csv("c.csv", CREW), name="forced"), wh)
    other = "badge,radio\nK9,ch16\n"
    s = LoadSpec("forced", "harbour desk", SourceSpec("csv", path=write_csv("d.csv", other)), DestinationSpec("raw", "forced_v2"))
    assert run_load(spark, s, wh)["status"] == "failed"  # drift, not forced
    res = run_load(spark, s, wh, force=True)
    assert res["status"] == "success" and wh.read("raw_forced_v2").columns == ["badge", "radio"]
    unforced = run_load(spark, spec(write_csv("e.csv", CREW), name="forced"), wh)
    assert unforced["status"] == "failed" and "drift" in unforced["error_message"].lower()


def test_overwrite_spec_into_a_load_partitioned_table_fails_cleanly(spark, wh, write_csv):
    wh.ensure_load_table("raw_lp3", spark.createDataFrame([], "ticket int, fee int").schema)
    wh.append("raw_lp3", spark.createDataFrame([(1, 5)], "ticket int, fee int"))
    res = run_load(spark, spec(write_csv("o.csv", ORDERS), name="lp3", mode="overwrite"), wh)
    assert res["status"] == "failed" and "appends only" in res["error_message"]
    assert wh.read("raw_lp3").count() == 1


@pytest.mark.parametrize("unique", [["id"], []])
def test_late_rows_load_once_and_repeats_do_not(spark, wh, unique):
    state = RunState(wh)
    spec = LoadSpec("late", "team", SourceSpec("parquet", path="/none", incremental_key="k", look_back="5", unique_key=unique),
                    DestinationSpec("raw", "late"))
    load = lambda rows: run_load(spark, spec, wh, source=spark.createDataFrame(rows, "k int, id string"), state=state)
    assert load([(k, f"a{k}") for k in range(1, 11)])["rows_late"] == 0
    res = load([(3, "too late"), (6, "late"), (6, "a6"), (8, None), (9, "a9"), (11, "new"), (None, "unkeyed")])
    assert (res["status"], res["rows_extracted"], res["rows_late"], res["rows_without_key"]) == ("success", 3, 2, 1)
    res = load([(6, "late"), (8, None), (11, "new"), (7, "late too"), (12, "newer")])
    assert (res["rows_extracted"], res["rows_late"]) == (2, 1)
    got = sorted((r.k, str(r.id)) for r in wh.read("raw_late").collect())
    assert got == sorted([(k, f"a{k}") for k in range(1, 11)] + [(6, "late"), (8, "None"), (11, "new"), (7, "late too"), (12, "newer")])
    assert state.get_mark("late", "k") == "12"
    assert [r.rows_late for r in state.runs().orderBy("run_timestamp").collect()] == [0, 2, 1]


def test_a_look_back_reads_the_loads_that_reach_into_it(spark, wh):
    from flowtable.plans.runner import _loaded_rows

    state = RunState(wh)
    spec = LoadSpec("days", "team", SourceSpec("parquet", path="/none", incremental_key="d", look_back="2 days"), DestinationSpec("raw", "days"))
    for day in range(1, 7):
        df = spark.sql(f"SELECT DATE'2031-01-0{day}' AS d, {day} AS v")
        assert run_load(spark, spec, wh, source=df, state=state)["status"] == "success"
    assert sorted(r.v for r in _loaded_rows(df, spec, wh, state, "2031-01-06").collect()) == [5, 6]
    for bad in ({"load_mode": "overwrite"}, {"source": SourceSpec("parquet", path="/x", look_back="1")}):
        with pytest.raises(ValueError, match="look-back"):
            LoadSpec(**{"name": "p", "owner": "o", "source": spec.source, "destination": spec.destination} | bad)
