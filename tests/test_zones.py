import os

import pytest
from pyspark.sql import functions as F

from flowtable import DestinationSpec, LoadSpec, RunState, SourceSpec, run_load
from flowtable.operators.zones import ZONES_TABLE, landed_files

SCHEMA = "id long, ts timestamp_ntz, note string"


def _rows(spark, lo, hi):
    return spark.range(lo, hi).select("id", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id AS int))").alias("ts"),
                                      F.concat(F.lit("row "), "id").alias("note"))


def _land(spark, folder, kind, lo, hi):
    """One file of consecutive keys, under a name with a space."""
    rows = _rows(spark, lo, hi).toPandas()
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/part {lo}.{kind}"
    rows["ts"] = rows["ts"].astype("datetime64[us]")
    if kind == "csv":
        rows.to_csv(path, index=False)
    elif kind == "json":
        rows.assign(ts=rows["ts"].astype(str)).to_json(path, orient="records", lines=True)
    else:
        rows.to_parquet(path, index=False)
    return path


def _spec(folder, kind, key="ts"):
    return LoadSpec("feed", "ops", SourceSpec(kind, folder, incremental_key=key, zone_map=True, schema=None if kind == "parquet" else SCHEMA),
                    DestinationSpec("raw", "feed"))


def _opened(wh, spec):
    return landed_files(wh, spec.name, spec.source, RunState(wh).get_mark(spec.name, spec.source.incremental_key))


@pytest.mark.parametrize("kind,key", [("csv", "ts"), ("json", "id"), ("parquet", "ts")])
def test_only_files_above_the_mark_are_opened(spark, wh, tmp_path, kind, key):
    folder = str(tmp_path / "landing")
    for i in range(12):
        _land(spark, folder, kind, 10 * i, 10 * i + 10)
    spec = _spec(folder, kind, key)
    first = run_load(spark, spec, wh)
    assert (first["status"], first["rows_loaded"]) == ("success", 120), first
    new = [_land(spark, folder, kind, 10 * i, 10 * i + 10) for i in (12, 13)]
    found = _opened(wh, spec)
    assert [p.split("/")[-1] for p in found.opened] == [p.split("/")[-1] for p in new] and found.skipped == 12
    assert len(found.rows.inputFiles()) == 2
    assert run_load(spark, spec, wh)["rows_loaded"] == 20
    assert _opened(wh, spec).opened == []
    again = run_load(spark, spec, wh)
    assert (again["status"], again["rows_loaded"]) == ("success", 0), again
    assert sorted(r["id"] for r in wh.read("raw_feed").collect()) == list(range(140))
    assert wh.read(ZONES_TABLE).count() == 14


def test_a_rewritten_file_is_opened_again(spark, wh, tmp_path):
    folder = str(tmp_path / "landing")
    path = _land(spark, folder, "csv", 0, 10)
    _land(spark, folder, "csv", 10, 20)
    spec = _spec(folder, "csv")
    assert run_load(spark, spec, wh)["rows_loaded"] == 20
    _rows(spark, 0, 30).toPandas().to_csv(path, index=False)
    found = _opened(wh, spec)
    assert len(found.opened) == 1 and found.skipped == 1
    assert run_load(spark, spec, wh)["rows_loaded"] == 10
    assert _opened(wh, spec).opened == []


def test_files_without_keys_or_rows_and_a_failed_load(spark, wh, tmp_path):
    folder = str(tmp_path / "landing")
    _land(spark, folder, "csv", 0, 10)
    (tmp_path / "landing" / "empty.csv").write_text("id,ts,note\n")
    (tmp_path / "landing" / "keyless.csv").write_text("id,ts,note\n5,,x\n6,,y\n")
    spec = _spec(folder, "csv")
    first = run_load(spark, spec, wh)
    assert (first["rows_loaded"], first["rows_without_key"]) == (10, 2)
    assert _opened(wh, spec).skipped == 3
    _land(spark, folder, "csv", 10, 20)
    failed = run_load(spark, LoadSpec("feed", "ops", SourceSpec("csv", folder, incremental_key="gone", zone_map=True, schema=SCHEMA),
                                      DestinationSpec("raw", "feed")), wh)
    assert failed["status"] == "failed" and "gone" in failed["error_message"]
    assert run_load(spark, spec, wh)["rows_loaded"] == 10


def test_a_missing_folder_and_specs_that_cannot_have_zones(spark, wh, tmp_path):
    missing = run_load(spark, _spec(str(tmp_path / "nowhere"), "csv"), wh)
    assert missing["status"] == "failed" and "nowhere" in missing["error_message"]
    for wrong in (dict(incremental_key=None), dict(schema=None), dict(look_back="1 day"), dict(type="api")):
        with pytest.raises(ValueError):
            LoadSpec("feed", "ops", SourceSpec(**{"type": "csv", "path": "x", "incremental_key": "ts", "zone_map": True, "schema": SCHEMA, **wrong}),
                     DestinationSpec("raw", "feed"))


def test_partition_folders_are_refused(spark, wh, tmp_path):
    _land(spark, str(tmp_path / "landing" / "day=1"), "csv", 0, 10)
    got = run_load(spark, _spec(str(tmp_path / "landing"), "csv"), wh)
    assert got["status"] == "failed" and "partition folders" in got["error_message"]
