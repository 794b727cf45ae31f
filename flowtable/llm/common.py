"""Helpers shared by the operators: table access, reliable cuts in the plan, text columns in Arrow."""

from __future__ import annotations

import ctypes
import functools
import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from flowtable.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for those that can't import it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(), "flowtable_code.zip")  # read by the driver's file server alone
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(top, "flowtable")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, top))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def shipped(query):
    """``query`` with the code sent first."""
    @functools.wraps(query)
    def run(spark: SparkSession, *args):
        ship_code(spark)
        return query(spark, *args)
    return run


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared scratch folder and read back.

    Cuts the lineage, survives lost executors and gives the planner real sizes.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def return_memory() -> None:
    """Return to the system what Arrow and the C library keep for later; nothing in use is touched."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def gives_back(run):
    """``run`` over Arrow batches; at a task's end its worker returns the memory that it keeps for later.

    A worker outlives its tasks, so what it keeps would stay beside all later stages of the executor.
    """
    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            return_memory()
    return task


def utf8_list(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def text_list(column: pa.Array) -> list[str]:
    """Strings of a column; null is empty."""
    return [x or "" for x in column.to_pylist()]



def mapped(df: DataFrame, source: str, result: StructField, run) -> DataFrame:
    """``df`` with column ``source`` mapped to ``result`` by ``run`` over Arrow batches.

    A column of the result's name, in any case, is replaced.  The others pass through under plain names, since
    a map over batches can't take names with dots or quotes.
    """
    others = [f for f in df.schema.fields if f.name.lower() not in (source.lower(), result.name.lower())]
    plain = [StructField(f"_{i}", f.dataType) for i, f in enumerate(others)]
    given = [F.col("`" + f.name.replace("`", "``") + "`").alias(p.name) for f, p in zip(others, plain)]
    return df.select(*given, source).mapInArrow(run, StructType([*plain, result])).toDF(*[f.name for f in others], result.name)
