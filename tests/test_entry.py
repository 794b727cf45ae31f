import os
import subprocess
import sys

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from flowtable.plans.verification import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
ALL = sorted(QUERIES)


def test_contract_keys_match():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("gone", ["xxhash", "flowtable.llm", "corpus_pipeline"])
def test_the_rest_is_registered_without_the_optional_part(gone):
    code = (f"import sys; sys.modules[{gone!r}] = None; import __spark_entry__ as e; from flowtable.plans.verification import QUERIES; "
            "assert set(QUERIES) <= set(e.queries()) and 'pipeline' not in e.queries() and set(QUERIES) <= set(e.oracle_sql())")
    subprocess.run([sys.executable, "-W", "ignore", "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["user_id", "day", "n_events", "n_types", "top_value"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(df: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and pd.isna(v)):
            return None
        if hasattr(v, "item") and not isinstance(v, pd.Timestamp):
            v = v.item()
        if isinstance(v, float):
            return round(v, 6)
        if isinstance(v, pd.Timestamp):
            return v.isoformat()
        return v
    cols = sorted(df.columns)
    return sorted((tuple(cell(v) for v in row) for row in df[cols].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", ALL)
def test_query_matches_oracle(spark, duck, name):
    got = queries()[name](spark, SF).toPandas()
    want = duck.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _norm(got) == _norm(want)
