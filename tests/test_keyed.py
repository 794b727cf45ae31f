import random

import pytest
from pyspark.sql import functions as F

from flowtable.operators.keyed import KeyedTable
from flowtable.operators.sinks import Warehouse

SCHEMA = "k long, `name of` string, v int"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def content(table):
    return {r["k"]: (r["name of"], r["v"]) for r in table.read().collect()}


def test_keyed_table_equals_a_dict_model(spark, wh):
    rng, model = random.Random(3), {}
    t = KeyedTable(wh, "t", ["k"], frame(spark, []).schema, buckets=5, merge_at=3)
    for step in range(9):
        keys = rng.sample(range(60), 12)
        kind = ("upsert", "part", "absent", "update")[step % 4]
        if kind == "upsert":
            rows = [(k, f"n{step}", step) for k in keys] + [(keys[0], "older", -1)]
            assert t.upsert(frame(spark, rows), order_by=["v"]) == 12
            model |= {k: (f"n{step}", step) for k in keys}
        elif kind == "part":
            assert t.upsert(frame(spark, [(k, step) for k in keys], "k int, v int")) == 12
            model |= {k: (model.get(k, (None,))[0], step) for k in keys}
        elif kind == "absent":
            rows = [(k, f"late{i}", i) for k in keys for i in (2, 1)]
            assert t.insert_if_absent(frame(spark, rows), ["v"]) == len([k for k in keys if k not in model])
            model |= {k: ("late1", 1) for k in keys if k not in model}
        else:
            assert t.update_by_key(frame(spark, [(k, -step) for k in keys], "k long, w int"), {"v": "w"}) == len(set(keys) & set(model))
            model |= {k: (model[k][0], -step) for k in keys if k in model}
        assert content(t) == model, (step, kind)
        assert len(t.deltas()) < 3
        if step == 5:
            t.compact()
            assert t.deltas() == [] and content(t) == model
    t.compact()
    assert content(KeyedTable(wh, "t", ["k"])) == model


def test_small_updates_write_in_proportion(spark, wh):
    big = spark.range(200_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("name of"), F.lit(0).alias("v"))
    t = KeyedTable(wh, "t", ["k"], big.schema, buckets=8)
    assert t.upsert(big) == 200_000
    size = lambda: sum(r.n for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(
        f"{wh.root}/t__rows").select(F.col("length").alias("n")).collect())
    before = size()
    some = big.where("k % 200 = 7").withColumn("v", F.lit(1))
    assert t.upsert(some) == 1000
    assert size() - before < before * 0.03
    assert t.update_by_key(some.select("k", F.lit(2).alias("w")), {"v": "w"}) == 1000
    assert size() - before < before * 0.06
    got = t.read().groupBy("v").count().collect()
    assert {r.v: r["count"] for r in got} == {0: 199_000, 2: 1000}


def test_filters_name_the_buckets_that_may_hold_a_key(spark, wh):
    t = KeyedTable(wh, "t", ["k"], frame(spark, []).schema, buckets=16)
    known = spark.range(0, 40_000, 2).select(F.col("id").alias("k"), F.lit("x").alias("name of"), F.lit(1).alias("v"))
    t.upsert(known)
    all_known = t.buckets_asked(known.select("k"))
    assert all_known == list(range(16))  # a filter never misses a key
    one = t.buckets_asked(frame(spark, [(4,)], "k long"))
    assert one == [r[0] for r in frame(spark, [(4,)], "k long").select(t._bucket()).collect()]
    asked = [t.buckets_asked(frame(spark, [(2 * i + 1,)], "k long")) for i in range(6)]
    assert sum(map(len, asked)) <= 1  # absent keys: no bucket is read
    assert t.insert_if_absent(frame(spark, [(i, "new", 2) for i in range(100)]), ["v"]) == 50
    assert t.read().count() == 20_050


def test_a_crash_between_two_catalog_calls_changes_nothing(spark, wh, monkeypatch):
    t = KeyedTable(wh, "t", ["k"], frame(spark, []).schema, buckets=3, merge_at=0)
    t.upsert(frame(spark, [(i, "base", 0) for i in range(20)]))
    for step in (1, 2, 3):
        t.upsert(frame(spark, [(i, f"d{step}", step) for i in range(step, 20, 5)]))
    want = content(t)
    for job in (t.merge_deltas, t.compact):
        with monkeypatch.context() as m:
            m.setattr(KeyedTable, "_drop", lambda *a: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                job()
        assert content(t) == want and t.read().count() == 20
    t.compact()
    assert content(t) == want and t.deltas() == []


def test_the_base_is_read_without_a_shuffle(spark, wh):
    t = KeyedTable(wh, "t", ["k"], frame(spark, []).schema, buckets=3)
    t.upsert(frame(spark, [(i, "base", 0) for i in range(50)]))
    t.upsert(frame(spark, [(7, "new", 1)]))
    plan = t.read()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "LeftAnti" in plan


def test_what_is_refused(spark, wh):
    with pytest.raises(ValueError, match="no keyed table"):
        KeyedTable(wh, "t", ["k"])
    with pytest.raises(ValueError, match="not in columns"):
        KeyedTable(wh, "t", ["gone"], frame(spark, []).schema)
    t = KeyedTable(wh, "t", ["k"], frame(spark, []).schema)
    with pytest.raises(ValueError, match="keyed by"):
        KeyedTable(wh, "t", ["v"])
    for rows in ([(None, "a", 1)], [(1, "a", 1), (1, "b", 2)]):
        with pytest.raises(ValueError, match="must not be NULL"):
            t.upsert(frame(spark, rows))
    assert t.read().count() == 0 and t.insert_if_absent(frame(spark, []), ["v"]) == 0
    assert t.update_by_key(frame(spark, [(1, 2)], "k long, w int"), {"v": "w"}) == 0


def test_keys_of_several_columns(spark):
    wh = Warehouse.scratch(spark, "two")
    t = KeyedTable(wh, "t", ["a", "b c"], frame(spark, [], "a string, `b c` int, v int").schema, buckets=4)
    t.upsert(frame(spark, [("x", 1, 0), ("x", 2, 0), ("", 1, 0)], "a string, `b c` int, v int"))
    t.upsert(frame(spark, [("x", 2, 5), ("y", 2, 6)], "a string, `b c` int, v int"))
    assert sorted(map(tuple, t.read().collect())) == [("", 1, 0), ("x", 1, 0), ("x", 2, 5), ("y", 2, 6)]
