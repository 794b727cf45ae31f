import re

import pytest
from pyspark.sql import functions as F

from flowtable.operators import refresh as R
from flowtable.operators.refresh import GroupTable, Measure, RowTable, fold, refresh, unread_loads
from flowtable.operators.sinks import LOAD_ID, Warehouse
from flowtable.plans.runner import run_load
from flowtable.plans.spec import DestinationSpec, LoadSpec, SourceSpec, TransformSpec

SCHEMA = "user int, kind string, value long, price decimal(9,2)"
LOADS = {
    "l1": [(1, "a", 5, 1.5), (1, "b", 7, 2.25), (2, "a", None, None), (None, "a", 1, 1.0)],
    "l2": [(2, "c", 9, 4.0), (3, None, 2, 0.5)],
    "l3": [(1, "a", -3, 9.75), (None, None, None, None)],
}
ROWS = RowTable("tidy", {"user": "user", "label": "upper(kind)", "twice": "value * 2"}, where="value IS NOT NULL")
GROUPS = GroupTable("per_user", {"user": "user"}, {
    "n": Measure("count"), "n_values": Measure("count", "value"), "total": Measure("sum", "value"), "paid": Measure("sum", "price"),
    "least": Measure("min", "value"), "most": Measure("max", "price"), "mean": Measure("avg", "value"),
    "kinds": Measure("count_distinct", "kind")})


def publish(spark, wh, load):
    from decimal import Decimal

    rows = [(u, k, v, None if p is None else Decimal(str(p))) for u, k, v, p in LOADS[load]]
    df = spark.createDataFrame(rows, SCHEMA)
    path = wh.load_path("src", load)
    df.write.parquet(path)
    wh.publish_load("src", load, path, df.schema)


def rebuilt(wh):
    src = wh.read("src")
    rows = src.where("value IS NOT NULL").select("user", F.upper("kind"), F.col("value") * 2)
    groups = src.groupBy("user").agg(F.count("*"), F.count("value"), F.sum("value"), F.sum("price"), F.min("value"), F.max("price"),
                                     F.avg("value"), F.countDistinct("kind"))
    return [sorted(map(repr, map(tuple, df.collect()))) for df in (rows, groups)]


def current(wh):
    return [sorted(map(repr, map(tuple, wh.read(t).collect()))) for t in ("tidy", "per_user")]


def test_derived_tables_follow_loads_and_equal_a_rebuild(spark, wh):
    for load in LOADS:
        publish(spark, wh, load)
        assert refresh(wh, "src", ROWS) == [load] and refresh(wh, "src", GROUPS) == [load]
        assert current(wh) == rebuilt(wh)
    assert refresh(wh, "src", ROWS) == [] and refresh(wh, "src", GROUPS) == []
    assert wh.read("per_user").columns == ["user", *GROUPS.measures]


def test_many_loads_at_once_with_empty_ones_and_a_fold_between(spark, wh, monkeypatch):
    monkeypatch.setattr(R, "LOADS_AT_ONCE", 2)
    publish(spark, wh, "l1")
    path = wh.load_path("src", "empty:load")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    wh.publish_load("src", "empty:load", path, wh.schema("src"))
    publish(spark, wh, "l2")
    assert refresh(wh, "src", ROWS) == refresh(wh, "src", GROUPS) == ["empty:load", "l1", "l2"]
    assert current(wh) == rebuilt(wh)
    fold(wh, GROUPS)
    assert current(wh) == rebuilt(wh) and refresh(wh, "src", GROUPS) == []
    publish(spark, wh, "l3")
    assert refresh(wh, "src", GROUPS) == ["l3"] and refresh(wh, "src", ROWS) == ["l3"]
    fold(wh, GROUPS)
    assert current(wh) == rebuilt(wh) and refresh(wh, "src", GROUPS) == []
    assert wh.loads(R._partials_of(wh, GROUPS)) == [R.FOLDED]


def test_a_refresh_or_fold_that_is_lost_adds_nothing_twice(spark, wh, monkeypatch):
    publish(spark, wh, "l1")
    refresh(wh, "src", GROUPS)
    publish(spark, wh, "l2")
    publish(spark, wh, "l3")
    real, done = Warehouse.publish_load, []

    def lost(self, table, load, *args):
        if done:
            raise OSError("lost")
        done.append(load)
        real(self, table, load, *args)

    with monkeypatch.context() as m:
        m.setattr(Warehouse, "publish_load", lost)
        with pytest.raises(OSError):
            refresh(wh, "src", GROUPS)
    assert refresh(wh, "src", GROUPS) == ["l3"]
    with monkeypatch.context() as m:
        m.setattr(R, "_show", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            fold(wh, GROUPS)
    refresh(wh, "src", ROWS)
    assert current(wh) == rebuilt(wh)
    fold(wh, GROUPS)
    assert current(wh) == rebuilt(wh)


def test_a_refresh_reads_the_new_load_alone(spark, wh):
    for load in LOADS:
        publish(spark, wh, load)
    df = unread_loads(wh, "src", ["l2"])
    assert len(df.inputFiles()) == len(wh.read_load("src", "l2").inputFiles()) < len(wh.read("src").inputFiles())
    assert re.search(r"PartitionFilters: \[.*_load_id", df._jdf.queryExecution().executedPlan().toString())


def test_a_table_without_groups_or_distinct_values_and_one_of_no_loads(spark, wh):
    total = GroupTable("total", {}, {"n": Measure("count"), "top": Measure("max", "value")})
    wh.ensure_load_table("src", spark.createDataFrame([], SCHEMA).schema)
    for t in (ROWS, GROUPS):
        refresh(wh, "src", t)
    assert wh.read("per_user").count() == 0
    for load in LOADS:
        publish(spark, wh, load)
    refresh(wh, "src", total)
    assert tuple(wh.read("total").first()) == (8, 9)


def test_what_cannot_follow_is_refused(spark, wh):
    with pytest.raises(ValueError, match="not mergeable"):
        GroupTable("t", {}, {"x": Measure("median", "v")})
    with pytest.raises(ValueError, match="without an expression"):
        GroupTable("t", {}, {"x": Measure("sum")})
    with pytest.raises(ValueError, match="counted distinctly"):
        GroupTable("t", {}, {"x": Measure("count_distinct", "a"), "y": Measure("count_distinct", "b")})
    wh.overwrite("plain", spark.range(3))
    with pytest.raises(ValueError, match="not load-partitioned"):
        refresh(wh, "plain", RowTable("d", {"id": "id"}))
    publish(spark, wh, "l1")
    wh.overwrite("per_user", spark.range(3))
    with pytest.raises(ValueError, match="not a derived table"):
        refresh(wh, "src", GROUPS)
    with pytest.raises(ValueError, match="load-partitioned append"):
        LoadSpec("p", "o", SourceSpec("parquet", path="/x"), DestinationSpec("raw", "x"), load_mode="overwrite",
                 transform=TransformSpec(derived=[ROWS]))


def test_loads_refresh_their_derived_tables(spark, wh):
    doc = {"pipeline_name": "p", "source": {"type": "parquet", "path": "/none", "incremental_key": "id"},
           "destination": {"schema": "raw", "table": "x"},
           "transform": {"derived": [{"target": "odd", "columns": {"id": "id"}, "where": "id % 2 = 1"},
                                     {"target": "sums", "keys": {"r": "id % 3"}, "measures": {"s": {"kind": "sum", "expr": "id"}}}]}}
    spec = LoadSpec.from_dict(doc)
    for upto in (10, 25):
        assert run_load(spark, spec, wh, source=spark.range(upto))["status"] == "success"
        assert sorted(r.id for r in wh.read("odd").collect()) == list(range(1, upto, 2))
        assert {r.r: r.s for r in wh.read("sums").collect()} == {r: sum(range(r, upto, 3)) for r in range(3)}
    assert len(wh.loads("odd")) == 2 and LOAD_ID not in wh.read("odd").columns
