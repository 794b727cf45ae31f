import pytest

from flowtable.operators.runlog import failure_alerts, format_alert, latest_failure, run_health
from flowtable.plans.journal import Journal
from flowtable.plans.runner import destination_conflicts
from flowtable.plans.spec import DestinationSpec, LoadSpec, SourceSpec
from flowtable.plans.state import RunState


def spec(name, owner="o", mode="append", schema="raw", table=None):
    return LoadSpec(name, owner, SourceSpec("csv", path="/x.csv"), DestinationSpec(schema, table or name), load_mode=mode,
                    schedule="@daily")


def test_fresh_state_is_empty(spark, wh):
    assert RunState(wh).pipelines().count() == 0


def test_register_upserts_and_keeps_created_at(spark, wh):
    st = RunState(wh)
    st.register(spec("pipe_a"))
    first = st.pipelines().first()
    st.register(spec("pipe_a", mode="overwrite"))
    rows = st.pipelines().collect()
    assert len(rows) == 1
    assert rows[0].load_mode == "overwrite" and rows[0].created_at == first.created_at
    assert rows[0].last_status is None and rows[0].source_identifier == "/x.csv"


def test_last_status_follows_latest_run(spark, wh):
    st = RunState(wh)
    st.register(spec("p"))
    st.log_run("1", "p", "SUCCESS", 1, 1, 0.1, None)
    assert st.pipelines().first().last_status == "SUCCESS"
    st.log_run("2", "p", "FAILED", 1, 0, 0.1, "x")
    row = st.pipelines().first()
    assert row.last_status == "FAILED" and row.last_run_at is not None and row.updated_at >= row.created_at


def test_registered_names_sorted(spark, wh):
    st = RunState(wh)
    for n in ("gamma", "alpha", "beta"):
        st.register(spec(n))
    assert [r.pipeline_name for r in st.health().collect()] == ["alpha", "beta", "gamma"]


def test_log_run_with_quotes_and_null_error(spark, wh):
    st = RunState(wh)
    st.log_run("r1", "o'brien's pipe", "FAILED", 1, 0, 0.5, "value 'x' isn't valid")
    st.log_run("r2", "o'brien's pipe", "SUCCESS", 1, 1, 0.5, None)
    rows = {r.run_id: r for r in st.runs().collect()}
    assert rows["r1"].error_message == "value 'x' isn't valid"
    assert rows["r2"].error_message is None


def test_health_summary_counts_and_last_error(spark, wh):
    st = RunState(wh)
    st.register(spec("a"))
    st.register(spec("never"))
    st.log_run("1", "a", "FAILED", 0, 0, 1.0, "boom " * 50)
    st.log_run("2", "a", "SUCCESS", 2, 2, 1.0, None)
    rows = {r.pipeline_name: r for r in st.health().collect()}
    assert rows["a"].total_runs == 2 and rows["a"].failures == 1
    assert rows["a"].last_status == "SUCCESS"
    assert rows["a"].last_error == ("boom " * 50)[:120]
    assert rows["never"].total_runs == 0 and rows["never"].last_status is None


def test_versions_record_only_changes(spark, wh):
    st = RunState(wh)
    assert st.track_version(spec("p")) is True
    assert st.track_version(spec("p")) is False
    assert st.track_version(spec("p", mode="overwrite")) is True
    assert st.track_version(spec("p")) is True  # a revert is a change too
    assert st.track_version(spec("q")) is True
    rows = st.versions().where("pipeline_name = 'p'").orderBy("seq").collect()
    assert len(rows) == 3 and all(len(r.version_hash) == 16 for r in rows)
    assert '"load_mode": "append"' in rows[0].config_snapshot


def test_destination_conflicts_on_physical_name(spark):
    specs = [spec("p1", table="orders"), spec("p2", table="orders"), spec("p3", schema="raw_orders", table="x"),
             spec("p4", schema="raw", table="orders_x"), spec("p5", table="other")]
    rows = {r.destination: r for r in destination_conflicts(spark, specs).collect()}
    assert set(rows) == {"raw_orders", "raw_orders_x"}
    assert rows["raw_orders"].first_claimant == "p1" and rows["raw_orders"].n_owners == 2


def test_failure_alerts_text(spark):
    runs = spark.createDataFrame([("r1", "p", "FAILED", "e" * 600), ("r2", "p", "SUCCESS", None)],
                                 "run_id string, pipeline_name string, status string, error_message string")
    rows = failure_alerts(runs).collect()
    assert len(rows) == 1
    assert rows[0].message == format_alert("p", "r1", "e" * 600)
    assert rows[0].message.endswith("*Error:* " + "e" * 500)


def test_latest_failure(spark):
    runs = spark.createDataFrame(
        [("p", "FAILED", 1, "old"), ("p", "FAILED", 3, "new"), ("p", "SUCCESS", 4, None), ("q", "SUCCESS", 1, None)],
        "pipeline_name string, status string, run_timestamp int, error_message string")
    rows = latest_failure(runs).collect()
    assert [(r.pipeline_name, r.last_error) for r in rows] == [("p", "new")]
    assert run_health(runs).where("pipeline_name = 'q'").first().last_error is None


def test_register_with_quotes_and_never_run_status(spark, wh):
    st = RunState(wh)
    st.register(spec("it's a pipe", owner="o'brien"))
    row = st.health().first()
    assert row.pipeline_name == "it's a pipe" and row.owner == "o'brien"
    assert row.status == "NEVER RUN" and row.indicator == "—" and row.total_runs == 0


def test_compact_keeps_events_and_probe_pushes_name_filter(spark, wh):
    st = RunState(wh)
    for n in ("a", "b", "c"):
        st.register(spec(n))
        st.log_run(f"r-{n}", n, "SUCCESS", 1, 1, 0.1, None)
    before = st.journal().count()
    st.compact()
    assert st.journal().count() == before
    assert [r.pipeline_name for r in st.health().collect()] == ["a", "b", "c"]
    plan = st.runs().where("pipeline_name = 'b'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(pipeline_name,b)" in plan


def test_journal_compacts_itself_when_segments_pile_up(spark, wh):
    st = RunState(wh, compact_at_files=6, check_every=3)
    for i in range(6):
        st.log_run(f"r{i}", "p", "SUCCESS", 1, 1, 0.1, None)
    assert len(st._journal.segments(st._journal.bucket_of("p"))) == 1
    assert st.runs().count() == 6


def test_the_journal_stays_small_over_many_processes(spark, wh):
    for i in range(11):  # a fresh object for every load, as in one process a load
        RunState(wh, compact_at_files=3).log_run(f"r{i}", "p", "SUCCESS", 1, 1, 0.1, None)
    st = RunState(wh)
    # tiers: nine runs are one segment of the second level, two are on their own
    assert [s[:2] for s in st._journal.segments(st._journal.bucket_of("p"))] == ["l0", "l0", "l2"]
    assert sorted(r.run_id for r in st.runs().collect()) == sorted(f"r{i}" for i in range(11))


def test_compaction_keeps_events_written_beside_it(spark, wh, monkeypatch):
    st, other = RunState(wh), RunState(wh)
    st.set_mark("p", "k", "1")
    st.set_mark("p", "k", "2")
    register, unregister = Journal._register, Journal._unregister

    def between_write_and_switch(self, bucket, segment, path):
        if segment.startswith("l1"):
            other.set_mark("p", "k", "3")
        register(self, bucket, segment, path)

    def between_switch_and_cleaning(self, bucket, segments):
        other.set_mark("p", "late", "4")
        assert st.marks().count() == 4  # old and new segments are both there: each event once
        unregister(self, bucket, segments)

    with monkeypatch.context() as m:
        m.setattr(Journal, "_register", between_write_and_switch)
        m.setattr(Journal, "_unregister", between_switch_and_cleaning)
        st.compact()
    assert st.get_mark("p", "k") == "3" and st.get_mark("p", "late") == "4"
    assert sorted(r.max_value for r in st.marks().collect()) == ["1", "2", "3", "4"]


def test_a_compaction_that_is_lost_half_way_counts_nothing_twice(spark, wh, monkeypatch):
    st = RunState(wh)
    for i in range(3):
        st.log_run(f"r{i}", "p", "SUCCESS", 1, 1, 0.1, None)
    with monkeypatch.context() as m:
        m.setattr(Journal, "_unregister", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            st.compact()
    assert st.runs().count() == 3 and st.health().count() == 0
    st.register(spec("p"))
    assert st.health().first().total_runs == 3
    st.compact()
    assert len(st._journal.segments(st._journal.bucket_of("p"))) == 1 and st.runs().count() == 3


def test_two_compactions_at_once_lose_and_double_nothing(spark, wh, monkeypatch):
    st, other = RunState(wh), RunState(wh)
    for i in range(4):
        st.log_run(f"r{i}", "p", "SUCCESS", 1, 1, 0.1, None)
    bucket = st._journal.bucket_of("p")
    listed = st._journal.segments(bucket)
    add = Journal._add

    def other_first(self, *args):
        if self is st._journal:
            other._journal.compact(bucket, listed)
        add(self, *args)

    monkeypatch.setattr(Journal, "_add", other_first)
    st._journal.compact(bucket, listed)
    monkeypatch.undo()
    assert len(st._journal.segments(bucket)) == 2 and st.runs().count() == 4
    st.compact()
    assert len(st._journal.segments(bucket)) == 1 and st.runs().count() == 4


def test_a_probe_reads_the_partition_of_its_name(spark, wh):
    st = RunState(wh)
    names = [f"n{i}" for i in range(8)]
    for n in names:
        st.set_mark(n, "k", n)
    assert all(st.get_mark(n, "k") == n for n in names[:3])
    read = st._mark_of("n7", "k")
    mine = st._journal.bucket_of("n7")
    assert len(read.inputFiles()) == len(st._journal.segments(mine)) < 8
    assert f"_name_bucket#" in (plan := read._jdf.queryExecution().executedPlan().toString()) and "PartitionFilters: [isnotnull(_name_bucket" in plan
