import hashlib
import json

import pytest
from pyspark.sql import functions as F

from flowtable.functions import (
    canonical_json,
    fingerprint,
    normalized_text,
    parses_as_timestamp,
    status_symbol,
    strict_timestamp,
    to_number,
    truncate,
    utc_now,
)


def test_normalized_text_and_truncate(spark):
    row = spark.createDataFrame([("  Click ",)], "t string").select(
        normalized_text("t").alias("n"), truncate(F.lit("abcdef"), 3).alias("x")).first()
    assert row.n == "click" and row.x == "abc"


def test_strict_timestamp_fails_on_bad_value(spark):
    ok = spark.createDataFrame([("2026-03-01 10:00:00",)], "t string").select(strict_timestamp("t").alias("v")).first()
    assert ok.v.year == 2026
    with pytest.raises(Exception):
        spark.createDataFrame([("nope",)], "t string").select(strict_timestamp("t")).collect()


def test_lenient_number_and_timestamp_tests(spark):
    rows = spark.createDataFrame([("1.5",), ("x",), ("1d",)], "t string").select(
        to_number("t").alias("n"), parses_as_timestamp("t").alias("p")).collect()
    assert [r.n for r in rows] == [1.5, None, 1.0]
    assert [r.p for r in rows] == [False, False, False]


def test_fingerprint_matches_python_sha256(spark):
    row = spark.createDataFrame([("F", "1-URGENT")], "s string, p string").select(
        canonical_json("s", "p").alias("j"), fingerprint("s", "p").alias("hj")).first()
    assert json.loads(row.j) == {"p": "1-URGENT", "s": "F"} and row.j.index('"p"') < row.j.index('"s"')
    assert row.hj == hashlib.sha256(row.j.encode()).hexdigest()[:16]


def test_canonical_json_keeps_nulls(spark):
    row = spark.createDataFrame([(None, 1)], "b string, a int").select(canonical_json("b", "a").alias("j")).first()
    assert row.j == '{"a":1,"b":null}'


def test_status_symbol_and_utc_now(spark):
    rows = spark.createDataFrame([("SUCCESS",), ("FAILED",), (None,)], "s string").select(status_symbol("s").alias("i")).collect()
    assert [r.i for r in rows] == ["✓", "✗", "—"]
    assert utc_now().tzinfo is None
