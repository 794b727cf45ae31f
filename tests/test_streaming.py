import pytest
from pyspark.sql import functions as F

from flowtable.operators.quality import Check
from flowtable.plans.spec import DestinationSpec, LoadSpec, QualitySpec, SourceSpec
from flowtable.plans.state import RunState
from flowtable.session import scratch_path
from flowtable.streaming import stream_load
from flowtable.streaming.available_now import first_of_each_key, rows_not_in

EVENTS = "/root/testdata/sf0.001/events.parquet"


def _spec():
    return LoadSpec("ev", "team", SourceSpec("parquet", path=EVENTS, incremental_key="ts"), DestinationSpec("raw", "ev"),
                    quality=QualitySpec(True, [Check("id", "event_id", "not_null")]))


def test_available_now_reads_only_new_files_and_new_rows(spark, wh):
    events = spark.read.parquet(EVENTS)
    split = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    landing, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "ckpt")
    state = RunState(wh)
    events.where(F.col("ts") <= split).write.parquet(landing)
    first = stream_load(spark, _spec(), wh, landing, ckpt, events.schema, state=state)
    assert sum(r["rows_loaded"] for r in first) == events.where(F.col("ts") <= split).count()
    # nothing new: the checkpoint knows the files, no batch runs
    assert stream_load(spark, _spec(), wh, landing, ckpt, events.schema, state=state) == []
    events.write.mode("append").parquet(landing)  # new files that repeat old rows
    second = stream_load(spark, _spec(), wh, landing, ckpt, events.schema, state=state)
    assert sum(r["rows_loaded"] for r in second) == events.where(F.col("ts") > split).count()
    assert wh.read("raw_ev").count() == events.count()
    assert wh.read("raw_ev").select("event_id").distinct().count() == events.count()


def test_replayed_batch_is_not_loaded_twice(spark, wh, tmp_path):
    import shutil

    events = spark.read.parquet(EVENTS)
    landing = str(tmp_path / "landing")
    ckpt = str(tmp_path / "ckpt")
    state = RunState(wh)
    events.write.parquet(landing)
    done = stream_load(spark, _spec(), wh, landing, ckpt, events.schema, state=state, run_tag="t1")
    assert len(done) == 1 and done[0]["rows_loaded"] == events.count()
    # the driver died after the load but before the batch was committed: same offsets, no commit
    replay = str(tmp_path / "ckpt-replay")
    shutil.copytree(ckpt, replay, ignore=lambda d, names: names if d.endswith("commits") else [])
    again = stream_load(spark, _spec(), wh, landing, replay, events.schema, state=state, run_tag="t1")
    assert again == []  # the replayed batch 0 was recognised and skipped
    assert wh.read("raw_ev").count() == events.count()


def test_available_now_over_csv_landing_files(spark, wh, tmp_path):
    landing = tmp_path / "csv_landing"
    landing.mkdir()
    (landing / "a.csv").write_text("id,amount\n1,10\n2,20\n")
    spec = LoadSpec("csv_stream", "team", SourceSpec("csv", path=str(landing), incremental_key="id"),
                    DestinationSpec("raw", "csv_stream"))
    schema = "id int, amount int"
    ckpt = str(tmp_path / "ckpt_csv")
    state = RunState(wh)
    first = stream_load(spark, spec, wh, str(landing), ckpt, schema, fmt="csv", options={"header": "true"}, state=state)
    (landing / "b.csv").write_text("id,amount\n2,20\n3,30\n")  # repeats id 2
    second = stream_load(spark, spec, wh, str(landing), ckpt, schema, fmt="csv", options={"header": "true"}, state=state)
    assert [r["rows_loaded"] for r in first + second] == [2, 1]
    assert sorted(r.id for r in wh.read("raw_csv_stream").collect()) == [1, 2, 3]


def test_backlog_is_split_into_micro_batches(spark, wh, tmp_path):
    landing = tmp_path / "backlog"
    landing.mkdir()
    for i in range(3):
        (landing / f"part{i}.csv").write_text(f"id,amount\n{i},1\n")
    spec = LoadSpec("backlog", "team", SourceSpec("csv", path=str(landing)), DestinationSpec("raw", "backlog"))
    state = RunState(wh)
    results = stream_load(spark, spec, wh, str(landing), str(tmp_path / "ckpt_b"), "id int, amount int", fmt="csv",
                          options={"header": "true"}, state=state, max_files_per_batch=1)
    assert len(results) == 3 and sum(r["rows_loaded"] for r in results) == 3
    assert state.runs().where("pipeline_name = 'backlog'").count() == 3


def test_a_backlog_out_of_key_order_loads_the_same_however_it_is_cut(spark, tmp_path):
    import os

    from flowtable.operators.sinks import Warehouse

    tables = []
    for cap in (1, 2, None):
        landing = tmp_path / f"landing{cap}"
        landing.mkdir()
        wh = Warehouse.scratch(spark, f"cap{cap}")
        state = RunState(wh)
        spec = LoadSpec("cut", "team", SourceSpec("csv", path=str(landing), incremental_key="id"), DestinationSpec("raw", "cut"))
        run = lambda: stream_load(spark, spec, wh, str(landing), str(tmp_path / f"ckpt{cap}"), "id int, v int", fmt="csv",
                                  options={"header": "true"}, state=state, max_files_per_batch=cap)
        for i, lo in enumerate((100, 0, 50)):
            (landing / f"f{i}.csv").write_text("id,v\n" + "".join(f"{k},{i}\n" for k in range(lo, lo + 10)))
            os.utime(landing / f"f{i}.csv", (1_000_000 + i, 1_000_000 + i))
        run()
        assert state.get_mark("cut", "id") == "109"
        (landing / "late.csv").write_text("id,v\n5,9\n109,9\n110,9\n")  # only 110 is above the stored mark
        run()
        assert state.get_mark("cut", "id") == "110"
        tables.append(sorted(tuple(r) for r in wh.read("raw_cut").collect()))
    assert tables[0] == tables[1] == tables[2] and len(tables[0]) == 31


def test_a_rejected_batch_is_tried_again_and_marks_wait_for_the_call(spark, wh, tmp_path):
    import os

    import pytest

    landing = tmp_path / "gate"
    landing.mkdir()
    for i, text in enumerate(("id,v\n100,1\n", "id,v\n7,\n")):
        (landing / f"f{i}.csv").write_text(text)
        os.utime(landing / f"f{i}.csv", (1_000_000 + i, 1_000_000 + i))
    state = RunState(wh)

    def run(checks):
        spec = LoadSpec("gate", "team", SourceSpec("csv", path=str(landing), incremental_key="id"), DestinationSpec("raw", "gate"),
                        quality=QualitySpec(bool(checks), checks))
        return stream_load(spark, spec, wh, str(landing), str(tmp_path / "ckpt_gate"), "id int, v int", fmt="csv",
                           options={"header": "true"}, state=state, max_files_per_batch=1)

    with pytest.raises(Exception, match="v_known"):
        run([Check("v_known", "v", "not_null")])
    assert state.get_mark("gate", "id") is None  # the call did not end
    assert sum(r["rows_loaded"] for r in run([])) == 1  # the rule was corrected: the rejected batch loads
    assert sorted(r.id for r in wh.read("raw_gate").collect()) == [7, 100] and state.get_mark("gate", "id") == "100"


def test_a_batch_published_before_the_crash_is_not_loaded_again(spark, wh, tmp_path, monkeypatch):
    import pytest

    events = spark.read.parquet(EVENTS)
    landing, ckpt = str(tmp_path / "landing"), str(tmp_path / "ckpt")
    state = RunState(wh)
    events.write.parquet(landing)
    with monkeypatch.context() as m:
        m.setattr(RunState, "_write", lambda self, rows: (_ for _ in ()).throw(OSError("driver lost")))
        with pytest.raises(Exception, match="driver lost"):
            stream_load(spark, _spec(), wh, landing, ckpt, events.schema, state=state)
    assert wh.read("raw_ev").count() == events.count()
    stream_load(spark, _spec(), wh, landing, ckpt, events.schema, state=state)
    assert wh.read("raw_ev").count() == events.count() and state.runs().where("status = 'SUCCESS'").count() == 1


def _files(landing, texts, first=0):
    import os

    landing.mkdir(exist_ok=True)
    for i, text in enumerate(texts, first):
        (landing / f"f{i}.csv").write_text("id,v\n" + text)
        os.utime(landing / f"f{i}.csv", (1_000_000 + i, 1_000_000 + i))


def _csv_load(spark, wh, state, tmp_path, checks=(), **options):
    landing = tmp_path / "land"
    spec = LoadSpec("cutoff", "team", SourceSpec("csv", path=str(landing), incremental_key="id"), DestinationSpec("raw", "cutoff"),
                    quality=QualitySpec(bool(checks), list(checks)))
    return stream_load(spark, spec, wh, str(landing), str(tmp_path / "ckpt"), "id int, v int", fmt="csv",
                       options={"header": "true"}, state=state, max_files_per_batch=1, **options)


@pytest.mark.parametrize("keyed", [False, True])
def test_rows_repeated_after_a_call_that_was_cut_off_load_once(spark, wh, tmp_path, keyed):
    state, options = RunState(wh), {"unique_key": ["id"]} if keyed else {}
    rows = lambda lo, hi: "".join(f"{k},1\n" for k in range(lo, hi))
    _files(tmp_path / "land", [rows(0, 10), rows(-5, 0) + "20,\n"])
    with pytest.raises(Exception, match="v_known"):
        _csv_load(spark, wh, state, tmp_path, [Check("v_known", "v", "not_null")], **options)
    _files(tmp_path / "land", [rows(0, 10), rows(3, 25)], first=2)  # repeats of the batch that was loaded, and more
    _csv_load(spark, wh, state, tmp_path, **options)
    got = [(r.id, r.v) for r in wh.read("raw_cutoff").collect()]
    want = {(k, 1) for k in range(-5, 25)} | {(20, None)}
    if keyed:  # 20 came without a value first; without a key these are different rows
        want.remove((20, 1))
    assert len(got) == len(want) and set(got) == want
    assert state.get_mark("cutoff", "id") == "24"
    _files(tmp_path / "land", [rows(-5, 30)], first=4)
    _csv_load(spark, wh, state, tmp_path, **options)
    assert len(wh.read("raw_cutoff").where("id >= 25").collect()) == 5
    assert len(wh.read("raw_cutoff").where("id < 10").collect()) == 15


def test_a_unique_key_drops_repeats_inside_a_backlog(spark, wh, tmp_path):
    state = RunState(wh)
    _files(tmp_path / "land", ["1,1\n1,1\n2,1\n", "2,2\n3,1\n,7\n", "3,3\n1,9\n4,1\n"])
    _csv_load(spark, wh, state, tmp_path, unique_key=["id"])
    assert sorted(r.id for r in wh.read("raw_cutoff").collect()) == [1, 2, 3, 4]
    first = {r.id: r.v for r in wh.read("raw_cutoff").collect()}
    assert first == {1: 1, 2: 1, 3: 1, 4: 1}


def test_rows_without_a_whole_key_are_compared_as_rows(spark):
    rows = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (None, "a", 1), (None, "a", 1), (None, "a", 2)], "k int, `k 2` string, v int")
    got = sorted(map(repr, map(tuple, first_of_each_key(rows, ["k", "k 2"]).collect())))
    assert len(got) == 3 and "(None, 'a', 1)" in got and "(None, 'a', 2)" in got
    with pytest.raises(ValueError, match="unique key"):
        first_of_each_key(rows, ["gone"])


def test_state_of_a_unique_key_bounded_by_event_time(spark, tmp_path):
    from flowtable.operators.sinks import Warehouse

    wh = Warehouse.scratch(spark, "bounded")
    state = RunState(wh)
    landing = tmp_path / "timed"
    landing.mkdir()
    spec = LoadSpec("timed", "team", SourceSpec("csv", path=str(landing), incremental_key="at"), DestinationSpec("raw", "timed"))
    run = lambda: stream_load(spark, spec, wh, str(landing), str(tmp_path / "ckpt_t"), "id int, at timestamp", fmt="csv",
                              options={"header": "true"}, state=state, unique_key=["id"], event_time="at", delay="1 day")
    (landing / "a.csv").write_text("id,at\n1,2024-01-01 00:00:00\n1,2024-01-01 00:00:00\n2,2024-01-01 10:00:00\n")
    run()
    (landing / "b.csv").write_text("id,at\n2,2024-01-01 12:00:00\n3,2024-01-01 11:00:00\n")
    run()
    assert sorted(r.id for r in wh.read("raw_timed").collect()) == [1, 2, 3]
    with pytest.raises(ValueError, match="all three"):
        stream_load(spark, spec, wh, str(landing), str(tmp_path / "x"), "id int, at timestamp", event_time="at")


def test_rows_not_in_takes_nulls_as_equal(spark):
    a = spark.createDataFrame([(1, None), (None, None), (2, {"k": 1}), (2, {"k": 2})], "a int, m map<string,int>")
    b = spark.createDataFrame([({"k": 1}, 2), (None, None)], "m map<string,int>, a long")
    assert sorted(map(repr, map(tuple, rows_not_in(a, b).collect()))) == ["(1, None)", "(2, {'k': 2})"]
