import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowtable.operators.sinks import Warehouse  # noqa: E402
from flowtable.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", app="flowtable-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture()
def wh(spark):
    return Warehouse.scratch(spark, "test")


@pytest.fixture()
def write_csv(tmp_path):
    def _write(name: str, text: str) -> str:
        path = tmp_path / name
        path.write_text(text, encoding="utf-8")
        return str(path)

    return _write
