from flowtable.functions import fingerprint
from flowtable.operators.changes import (
    changed_rows,
    duplicate_keys,
    first_by_key,
    key_conflicts,
    latest_by_key,
    track_versions,
    version_changes,
)


def test_latest_and_first_by_key_with_tie_break(spark):
    df = spark.createDataFrame([(1, 10, 1, "a"), (1, 10, 2, "b"), (1, 5, 9, "c"), (2, 1, 1, "d")],
                               "k int, ts int, id int, v string")
    assert {r.k: r.v for r in latest_by_key(df, ["k"], ["ts", "id"]).collect()} == {1: "b", 2: "d"}
    assert {r.k: r.v for r in first_by_key(df, ["k"], ["ts", "id"]).collect()} == {1: "c", 2: "d"}
    assert latest_by_key(df, ["k"], ["ts", "id"]).columns == df.columns


def test_changed_rows_keeps_first_and_changes(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, "b"), (1, 4, "a"), (2, 1, "a")], "k int, t int, v string")
    out = sorted((r.k, r.t) for r in changed_rows(df, ["k"], ["t"], "v").collect())
    assert out == [(1, 1), (1, 3), (1, 4), (2, 1)]


def test_version_changes_hash(spark):
    df = spark.createDataFrame([(1, 1, "F", "1-URGENT"), (1, 2, "F", "1-URGENT"), (1, 3, "O", "1-URGENT")],
                               "c int, t int, s string, p string")
    rows = version_changes(df, ["c"], ["t"], ["s", "p"]).orderBy("t").collect()
    assert [r.t for r in rows] == [1, 3]
    import hashlib
    assert rows[0].version_hash == hashlib.sha256(b'{"p":"1-URGENT","s":"F"}').hexdigest()[:16]


def test_versions_that_differ_in_nulls_and_separators_are_told_apart(spark):
    rows = [(1, 1, "x", None), (1, 2, None, "x"), (1, 3, "a|b", "c"), (1, 4, "a", "b|c"), (1, 5, "a", "b|c"), (1, 6, 'a"', ',"b'), (1, 7, 'a","', 'b')]
    df = spark.createDataFrame(rows, "c int, t int, s string, p string")
    assert sorted(r.t for r in version_changes(df, ["c"], ["t"], ["s", "p"]).collect()) == [1, 2, 3, 4, 6, 7]


def test_track_versions_appends_changed_entities(spark):
    hist = spark.createDataFrame([("a", "x", 1), ("b", "y", 1)], "name string, snap string, recorded_at int")
    hist = hist.withColumn("version_hash", fingerprint("snap")).select("name", "version_hash", "recorded_at")
    inc = spark.createDataFrame([("a", "x"), ("b", "z"), ("c", "w")], "name string, snap string")
    out = sorted(r.name for r in track_versions(hist, inc, ["name"], ["snap"]).collect())
    assert out == ["b", "c"]


def test_duplicate_keys_and_conflicts(spark):
    df = spark.createDataFrame([(1, 1, 7), (1, 1, 8), (1, 2, 7), (2, 1, 7)], "o int, l int, s int")
    assert [(r.o, r.l, r.n_rows) for r in duplicate_keys(df, ["o", "l"]).collect()] == [(1, 1, 2)]
    rows = key_conflicts(df, "o", "s").collect()
    assert [(r.o, r.n_owners, r.first_owner) for r in rows] == [(1, 2, 7)]


def test_changed_rows_hot_key_split_across_partitions(spark):
    """One key with most rows is cut into range slices; results equal the plain lag definition."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    hot = spark.range(0, 5000).select(F.lit(7).alias("k"), F.col("id").alias("t"), (F.col("id") / 3).cast("int").cast("string").alias("v"))
    cold = spark.range(0, 300).select((F.col("id") % 13).alias("k"), F.col("id").alias("t"), (F.col("id") % 2).cast("string").alias("v"))
    nulls = spark.range(0, 50).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("t"), F.lit(None).cast("string").alias("v"))
    df = hot.unionByName(cold).unionByName(nulls)
    got = changed_rows(df, ["k"], ["t"], "v", parts=16, hot_threshold=1000)
    w = Window.partitionBy("k").orderBy("t")
    want = (df.withColumn("previous_value", F.lag("v").over(w)).withColumn("rn", F.row_number().over(w))
              .where((F.col("rn") == 1) | ~F.col("v").eqNullSafe(F.col("previous_value"))).drop("rn"))
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # same answer on the plain path (no key counts as hot)
    plain = changed_rows(df, ["k"], ["t"], "v", parts=16)
    assert plain.exceptAll(want).count() == 0 and plain.count() == want.count()
    # the hot key really was spread over several slices
    sliced = df.repartitionByRange(16, "k", "t").withColumn("s", F.spark_partition_id())
    assert sliced.where("k = 7").select("s").distinct().count() > 4


def test_changed_rows_hot_null_key(spark):
    from pyspark.sql import functions as F

    df = spark.range(0, 300).select(
        F.when(F.col("id") < 200, F.lit(None)).otherwise(F.col("id") % 3).cast("long").alias("k"),
        F.col("id").alias("t"),
        (F.col("id") / 7).cast("int").cast("string").alias("v"),
    )
    sliced = changed_rows(df, ["k"], ["t"], "v", parts=8, hot_threshold=50)
    plain = changed_rows(df, ["k"], ["t"], "v", parts=8)
    assert sliced.count() == plain.count()
    assert sliced.exceptAll(plain).count() == 0
