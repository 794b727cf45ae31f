import pytest
from pyspark.sql import functions as F

from flowtable.operators.sinks import align_by_name, rows_absent_from, update_rows, upsert_rows
from flowtable.operators.transform import run_sql_transform


def test_ensure_table_creates_empty(spark, wh):
    assert wh.ensure_table("t", spark.createDataFrame([], "id int, v string").schema)
    assert not wh.ensure_table("t", spark.createDataFrame([], "id int, v string").schema)
    assert wh.read("t").count() == 0


def test_append_twice_and_count(spark, wh):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert wh.append("t", df) == 2
    assert wh.append("t", df) == 2
    assert wh.read("t").count() == 4


def test_overwrite_is_a_new_snapshot(spark, wh):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    wh.overwrite("t", df)
    first = wh.location("t")
    held = wh.read("t")  # a reader planned against the old snapshot
    assert wh.overwrite("t", df.limit(1)) == 1
    assert wh.location("t") != first
    assert wh.read("t").count() == 1
    assert held.count() in (1, 2)


def test_by_name_absent_columns_are_null_and_extra_fail(spark, wh):
    wh.append("t", spark.createDataFrame([(1, "a", 10)], "id int, v string, n int"))
    wh.append("t", spark.createDataFrame([("b", 2)], "v string, id int"))
    rows = {r.id: r for r in wh.read("t").collect()}
    assert rows[2].v == "b" and rows[2].n is None
    with pytest.raises(ValueError, match="not in target"):
        wh.append("t", spark.createDataFrame([(3, "zz")], "id int, surprise string"))


def test_align_casts_to_target(spark):
    target = spark.createDataFrame([], "id bigint, v string").schema
    out = align_by_name(spark.createDataFrame([(1,)], "id int"), target)
    assert out.dtypes == [("id", "bigint"), ("v", "string")]


def test_upsert_inserts_updates_and_preserves(spark):
    target = spark.createDataFrame([("p1", "alice", "2026-01-01", "SUCCESS"), ("p2", "bob", "2026-01-02", None)],
                                   "name string, owner string, created_at string, last_status string")
    updates = spark.createDataFrame([("p1", "carol", "2026-02-01"), ("p3", "dan", "2026-02-02")],
                                    "name string, owner string, created_at string")
    out = {r.name: r for r in upsert_rows(target, updates, ["name"], update_cols=["owner"]).collect()}
    assert out["p1"].owner == "carol" and out["p1"].created_at == "2026-01-01" and out["p1"].last_status == "SUCCESS"
    assert out["p2"].owner == "bob"
    assert out["p3"].owner == "dan" and out["p3"].created_at == "2026-02-02" and out["p3"].last_status is None


def test_upsert_dedupes_updates_by_order(spark, wh):
    wh.ensure_table("t", spark.createDataFrame([], "k int, v string, ts int").schema)
    ups = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "x", 5)], "k int, v string, ts int")
    wh.upsert("t", ups, ["k"], order_by=["ts"])
    wh.upsert("t", spark.createDataFrame([(2, "y", 6)], "k int, v string, ts int"), ["k"], order_by=["ts"])
    assert {r.k: r.v for r in wh.read("t").collect()} == {1: "new", 2: "y"}


def test_insert_if_absent(spark, wh):
    wh.append("t", spark.createDataFrame([(1, "a", 0)], "k int, v string, o int"))
    inc = spark.createDataFrame([(1, "b", 0), (2, "c", 5), (2, "d", 3)], "k int, v string, o int")
    assert rows_absent_from(wh.read("t"), inc, ["k"], ["o"]).count() == 1
    assert wh.insert_if_absent("t", inc, ["k"], ["o"]) == 1
    assert {r.k: r.v for r in wh.read("t").collect()} == {1: "a", 2: "d"}
    assert wh.insert_if_absent("t", inc, ["k"], ["o"]) == 0


def test_update_by_key(spark, wh):
    wh.overwrite("t", spark.createDataFrame([("a", None), ("b", None)], "name string, status string"))
    wh.update_by_key("t", spark.createDataFrame([("b", "FAILED")], "name string, s string"), ["name"], {"status": "s"})
    assert {r.name: r.status for r in wh.read("t").collect()} == {"a": None, "b": "FAILED"}
    out = update_rows(wh.read("t"), spark.createDataFrame([("a", "OK")], "name string, s string"), ["name"], {"status": "s"})
    assert {r.name: r.status for r in out.collect()} == {"a": "OK", "b": "FAILED"}


def test_sql_transform_drop_and_create(spark, wh):
    wh.overwrite("quay", spark.createDataFrame([(1, "cod", 2.5), (2, "cod", 4.0), (3, "hake", None)], "haul int, species string, kilos double"))
    sql = """
    -- heaviest haul of each species
    DROP TABLE IF EXISTS heaviest;
    CREATE TABLE heaviest AS
    SELECT species, max(kilos) AS kilos FROM quay GROUP BY species; /* one; row each */
    """
    assert run_sql_transform(wh, sql) == {"heaviest": 2}
    assert {r.species: r.kilos for r in wh.read("heaviest").collect()} == {"cod": 4.0, "hake": None}
    # a rebuild with a different schema replaces the table
    run_sql_transform(wh, "SELECT haul FROM quay", target="heaviest")
    assert wh.read("heaviest").columns == ["haul"]


def test_sql_transform_does_what_its_statements_say(spark, wh):
    wh.overwrite("quay", spark.range(3))
    wh.overwrite("kept", spark.range(5))
    assert run_sql_transform(wh, "CREATE TABLE IF NOT EXISTS kept AS SELECT id FROM quay") == {}
    assert wh.read("kept").count() == 5
    with pytest.raises(ValueError, match="exists"):
        run_sql_transform(wh, "CREATE TABLE kept AS SELECT id FROM quay")
    run_sql_transform(wh, "DROP TABLE kept")  # no rebuild: the table goes
    assert not wh.exists("kept")
    with pytest.raises(ValueError, match="no table"):
        run_sql_transform(wh, "DROP TABLE kept")
    run_sql_transform(wh, "DROP TABLE IF EXISTS kept")
    assert run_sql_transform(wh, f"CREATE TABLE {wh.database}.mine AS SELECT id FROM quay") == {"mine": 3}
    with pytest.raises(ValueError, match="elsewhere"):
        run_sql_transform(wh, "CREATE TABLE elsewhere.mine AS SELECT id FROM quay")
    assert run_sql_transform(wh, "CREATE TABLE hinted AS SELECT /*+ COALESCE(1) */ id /* a; b */ FROM quay") == {"hinted": 3}


def test_sql_transform_from_file(spark, wh, tmp_path):
    wh.overwrite("raw", spark.range(5).withColumn("v", F.col("id") * 2))
    f = tmp_path / "t.sql"
    f.write_text("CREATE OR REPLACE TABLE derived AS SELECT id FROM raw WHERE v > 4")
    run_sql_transform(wh, str(f))
    assert wh.read("derived").count() == 2
    with pytest.raises(FileNotFoundError):
        run_sql_transform(wh, str(tmp_path / "missing.sql"))


def test_parameterised_statement_is_quote_safe(spark, wh):
    wh.ensure_table("owners", spark.createDataFrame([], "name string, owner string").schema)
    wh.execute("INSERT INTO owners VALUES (?, ?)", ["o'brien pipe", "it's me"]).collect()
    rows = wh.execute("SELECT owner FROM owners WHERE name = :n", {"n": "o'brien pipe"}).collect()
    assert [r.owner for r in rows] == ["it's me"]


def _files(wh, table):
    """The files of each bucket of a keyed table."""
    out = {}
    for f in wh.spark.table(wh.qualified(table)).inputFiles():
        out.setdefault(f.split("_bucket=")[1].split("/")[0], set()).add(f)
    return out


def test_a_keyed_write_leaves_the_files_of_other_buckets(spark, wh):
    ups = spark.range(0, 2000).select((F.col("id") % 500).alias("k"), F.col("id").alias("ts"), F.lit("x").alias("v"))
    assert wh.upsert("keyed", ups, ["k"], order_by=["ts"], buckets=8) == 500
    b = wh.bucketing("keyed")
    assert b.columns == ("k",) and b.buckets == 8 and wh.read("keyed").columns == ["k", "ts", "v"]
    before = _files(wh, "keyed")
    assert len(before) == 8
    one = spark.createDataFrame([(17, 5000, "y")], "k long, ts long, v string")
    for write in (lambda: wh.upsert("keyed", one, ["k"]), lambda: wh.update_by_key("keyed", one.withColumn("v", F.lit("z")), ["k"], {"v": "v"})):
        assert write() < 150
        after = _files(wh, "keyed")
        assert sum(before[k] != after[k] for k in before) == 1
        before = after
    assert {r.v: r.n for r in wh.read("keyed").groupBy("v").agg(F.count("*").alias("n")).collect()} == {"x": 499, "z": 1}
    more = spark.createDataFrame([(17, 1, "no"), (9000, 1, "new")], "k int, ts long, v string")
    assert wh.insert_if_absent("keyed", more, ["k"], ["ts"]) == 1 and wh.read("keyed").count() == 501
    # a rewrite with fewer keys drops the buckets it has no rows for
    assert wh.overwrite("keyed", wh.read("keyed").where("k = 17")) == 1
    assert [r.v for r in wh.read("keyed").collect()] == ["z"] and wh.bucketing("keyed") == b


def test_compact_rewrites_into_fewer_files(spark, wh):
    import glob

    for i in range(5):
        wh.append("small", spark.range(i * 10, i * 10 + 10).repartition(3))
    before = len(glob.glob(wh.location("small").replace("file:", "") + "/*.parquet"))
    assert wh.compact("small", files=1) == 50
    after = glob.glob(wh.location("small").replace("file:", "") + "/*.parquet")
    assert before > 1 and len(after) == 1
    assert wh.read("small").count() == 50


def test_keyed_overwrite_writes_few_files(spark, wh):
    df = spark.range(0, 1000, numPartitions=6).withColumn("k", F.col("id") % 37)
    wh.overwrite("b", df, bucket_by=["k"], buckets=4)
    assert {k: len(v) for k, v in _files(wh, "b").items()} == {str(i): 1 for i in range(4)}
    assert wh.append("b", df.limit(10)) == 10 and wh.compact("b") == 1010 and wh.read("b").count() == 1010


def test_keys_must_be_present_and_unique(spark, wh):
    rows = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError, match="repeated"):
        wh.upsert("keys", rows, ["k"])
    wh.upsert("keys", rows.limit(1), ["k"])
    unkeyed = spark.createDataFrame([(None, "x", 1)], "k int, v string, o int")
    for write in (lambda: wh.upsert("keys", unkeyed.drop("o"), ["k"]), lambda: wh.insert_if_absent("keys", unkeyed, ["k"], ["o"]),
                  lambda: wh.update_by_key("keys", unkeyed, ["k"], {"v": "v"}, order_by=["o"])):
        with pytest.raises(ValueError, match="NULL"):
            write()
    assert wh.read("keys").count() == 1


def test_locations_with_quotes(spark, tmp_path):
    from flowtable.operators.sinks import Warehouse

    wh = Warehouse(spark, "ft_quoted", root=str(tmp_path / "o'brien's"))
    assert wh.overwrite("t", spark.range(3)) == 3 and wh.overwrite("t", spark.range(2)) == 2
    wh.ensure_load_table("l", spark.range(1).schema)
    assert wh.append("l", spark.range(4)) == 4 and wh.read("l").count() == 4


def test_upsert_rejects_unknown_columns(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError, match="not in target"):
        upsert_rows(target, spark.createDataFrame([(1, "b", 2)], "k int, v string, extra int"), ["k"])


def test_update_with_repeated_keys_takes_the_latest(spark, wh):
    wh.overwrite("t", spark.createDataFrame([("a", None), ("b", None)], "name string, status string"))
    ups = spark.createDataFrame([("a", "OLD", 1), ("a", "NEW", 2), ("b", "X", 1)], "name string, s string, o int")
    assert wh.update_by_key("t", ups, ["name"], {"status": "s"}, order_by=["o"]) == 2
    assert {r.name: r.status for r in wh.read("t").collect()} == {"a": "NEW", "b": "X"}


def test_append_into_a_load_partitioned_table_adds_a_load(spark, wh):
    wh.ensure_load_table("lp", spark.createDataFrame([], "k int, v string").schema)
    assert wh.append("lp", spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")) == 2
    assert wh.append("lp", spark.createDataFrame([(3,)], "k int")) == 1
    rows = wh.read("lp", load_id=True).collect()
    assert sorted(r.k for r in rows) == [1, 2, 3] and len({r._load_id for r in rows}) == 2


def test_bucketed_and_load_tables_accept_awkward_names_and_nested_types(spark, wh):
    df = spark.createDataFrame(
        [(1, "a", {"First Name": "x", "tags": ["t"]}, {"k": 1})],
        "`key col` int, `v`` q` string, nested struct<`First Name`: string, tags: array<string>>, m map<string,int>",
    )
    wh.overwrite("b", df, bucket_by=["key col"], buckets=2)
    assert wh.read("b").first()["nested"]["First Name"] == "x"
    wh.ensure_load_table("l", df.schema)
    wh.append("l", df)
    assert wh.read("l").first()["m"] == {"k": 1}


def test_load_partitioned_tables_refuse_rewrites(spark, wh):
    wh.ensure_load_table("lp2", spark.createDataFrame([], "k int").schema)
    wh.append("lp2", spark.createDataFrame([(1,)], "k int"))
    for rewrite in (lambda: wh.compact("lp2"), lambda: wh.overwrite("lp2", spark.createDataFrame([(2,)], "k int")),
                    lambda: wh.replace("lp2", spark.createDataFrame([(2,)], "k int")),
                    lambda: wh.upsert("lp2", spark.createDataFrame([(2,)], "k int"), ["k"])):
        with pytest.raises(ValueError, match="appends only"):
            rewrite()
    assert [r.k for r in wh.read("lp2").collect()] == [1]


def test_sql_transform_with_bound_parameters(spark, wh):
    wh.overwrite("raw", spark.createDataFrame([(1, "completed"), (2, "it's pending")], "id int, status string"))
    n = run_sql_transform(wh, "CREATE OR REPLACE TABLE picked AS SELECT id FROM raw WHERE status = :s", params={"s": "it's pending"})
    assert n == {"picked": 1} and wh.read("picked").first().id == 2


def test_sql_transform_keeps_semicolons_and_dashes_inside_literals(spark, wh):
    from flowtable.operators.transform import _statements

    sql = "-- lead comment\nSELECT 'a;b' AS x, 'c--d' AS y, `we;ird` FROM t; -- tail\nSELECT 1 AS z"
    assert _statements(sql) == ["SELECT 'a;b' AS x, 'c--d' AS y, `we;ird` FROM t", "SELECT 1 AS z"]
    assert _statements("SELECT 'it''s; fine' AS q") == ["SELECT 'it''s; fine' AS q"]
    wh.overwrite("raw_notes", spark.createDataFrame([(1, "a;b"), (2, "c--d")], "id int, note string"))
    run_sql_transform(wh, "CREATE OR REPLACE TABLE semi AS SELECT id FROM raw_notes WHERE note = 'a;b'; -- done")
    assert [r.id for r in wh.read("semi").collect()] == [1]
