"""Embedding whitening: leading principal components of all vectors, scaled to unit variance.

Vectors become integers, so their sums are exact.  Spark sums outer products of the centred vectors, one
matrix a task; the driver holds matrices of dimension by dimension only and finds the leading eigenpairs by
spectrum slicing (``spectrum``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtable.llm.common import table
from flowtable.llm.spectrum import leading_eigenpairs
from flowtable.llm.vectors import float_vector, matrix, scaled_floor, whole_vectors

LIMIT = 1 << 52  # scaled entries beyond are cut
LOW_BITS = 26  # sums are kept as two longs, so that neither overflows
CHUNK = 4096  # vectors handled at once in a task


def _chunks(batch: pa.RecordBatch):
    """``(rows, starts, lengths, values)`` of at most ``CHUNK`` whole vectors of the batch's column ``v``."""
    rows, starts, lengths, values = whole_vectors(batch.column("v"))
    for at in range(0, len(rows), CHUNK):
        part = slice(at, at + CHUNK)
        yield rows[part], starts[part], lengths[part], values


def _sums(vectors: DataFrame, scale: int, shift: int) -> tuple[int, list[int]]:
    """Number of whole vectors and exact sum of each component; absent components are zeros."""
    def partial(batches):
        for batch in batches:
            for _, starts, lengths, values in _chunks(batch):
                width = int(lengths.max())
                inside = np.arange(width) < lengths[:, None]
                x = scaled_floor(matrix(starts, lengths, values, width), scale, LIMIT)
                yield pa.RecordBatch.from_pydict({
                    "dim": pa.array(np.arange(-1, width)),
                    "n": pa.array(np.concatenate([[len(starts)], inside.sum(axis=0)])),
                    "hi": pa.array(np.concatenate([[0], (x >> LOW_BITS).sum(axis=0)])),
                    "lo": pa.array(np.concatenate([[0], (x & ((1 << LOW_BITS) - 1)).sum(axis=0)]))})

    found = {r["dim"]: r for r in vectors.select("v").mapInArrow(partial, "dim long, n long, hi long, lo long")
             .groupBy("dim").agg(F.sum("n").alias("n"), F.sum("hi").alias("hi"), F.sum("lo").alias("lo")).collect()}
    n = found[-1]["n"] if found else 0
    return n, [(found[j]["hi"] << LOW_BITS) + found[j]["lo"] + n * shift for j in range(len(found) - 1)]


class _Centre:
    """Integer vectors minus their mean, without cancellation: the whole part of the mean is taken off as an integer."""

    def __init__(self, n: int, sums: list[int], scale: int, shift: int):
        self.n, self.sums, self.scale, self.shift = n, sums, scale, shift
        self.whole = np.array([s // n for s in sums], dtype=np.int64)
        self.part = np.array([(s % n) / n for s in sums])

    def integers(self, starts, lengths, values) -> np.ndarray:
        return scaled_floor(matrix(starts, lengths, values, len(self.sums)), self.scale, LIMIT) + self.shift

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.part

    def deviation(self, x: np.ndarray, centred: np.ndarray) -> pa.Array:
        """Exact sum of ``(n x - S)^2``; null beyond a long."""
        wrap = np.array([s % (1 << 64) for s in self.sums], dtype=np.uint64).astype(np.int64)
        with np.errstate(over="ignore"):
            u = x * np.int64(self.n) - wrap  # exact modulo 2**64, hence exact where the sum fits a long
            total = (u * u).sum(axis=1)
        about = ((centred * float(self.n)) ** 2).sum(axis=1)
        return pa.array(total, mask=(about > 2.0 ** 63 * (1 + 1e-9)) | (total < 0))


def _second_moment(vectors: DataFrame, project, width: int) -> np.ndarray:
    """Sum of outer products of the rows that ``project`` makes of whole vectors: one matrix a task, added in Spark."""
    def partial(batches):
        total = np.zeros((width, width))
        for batch in batches:
            for _, *chunk in _chunks(batch):
                rows = project(*chunk)
                total += rows.T @ rows
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i.astype(np.int32)), "j": pa.array(j.astype(np.int32)),
                                          "v": pa.array(total[i, j])})

    out = np.zeros((width, width))
    for r in (vectors.select("v").mapInArrow(partial, "i int, j int, v double")
              .groupBy("i", "j").agg(F.sum("v").alias("v")).collect()):
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def whiten(df: DataFrame, id_col: str, vector_col: str, components: int = 32, scale: int = 64,
           shift: int = 1_000_000) -> DataFrame:
    """Whitened coordinates of every vector: ``id_col, component, n, deviation, whitened, explained, identity_error``.

    A vector entry c becomes ``floor(scale * c) + shift``.  Vectors that are null or hold null or non-finite
    entries take no part and have no rows.  Repeated rows and rows with a null id count, and come back, each.
    Shorter vectors meet longer ones as if filled with zero entries.  Components are numbered from 1 by falling
    eigenvalue of the covariance (divisor n); only those above rounding error exist, so that one vector, equal
    vectors, empty vectors or no vectors give no rows.  Equal eigenvalues share any orthonormal basis.
    ``deviation`` is null where it exceeds a long; scaled entries are cut to 2**52.  Other columns are not
    read.  The input is read four times: hand in a table rather than an expensive plan.
    """
    spark = df.sparkSession
    kind = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind)] + T._parse_datatype_string(
        "component int, n long, deviation long, whitened double, explained double, identity_error double").fields)
    vectors = df.select(F.col(f"`{id_col}`").alias("id"), float_vector(df, vector_col).alias("v"))
    n, sums = _sums(vectors, scale, shift)
    if not sums:
        return spark.createDataFrame([], schema)
    centre = _Centre(n, sums, scale, shift)
    covariance = _second_moment(vectors, lambda *chunk: centre.centred(centre.integers(*chunk)), len(sums)) / n
    values, axes = leading_eigenpairs(covariance, components)
    k = len(values)
    if not k:
        return spark.createDataFrame([], schema)
    basis = axes / np.sqrt(values)
    explained = values / np.trace(covariance)
    # the rows below are projections of centred rows, so their mean is zero
    of_whitened = _second_moment(vectors, lambda *chunk: centre.centred(centre.integers(*chunk)) @ basis, k) / n
    identity_error = float(np.abs(of_whitened - np.eye(k)).max())

    def rows(batches):
        for batch in batches:
            for at, *chunk in _chunks(batch):
                x = centre.integers(*chunk)
                centred = centre.centred(x)
                each = pa.array(np.repeat(np.arange(len(at)), k))
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").take(pa.array(np.repeat(at, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(len(at) * k, n)),
                    centre.deviation(x, centred).take(each),
                    pa.array((centred @ basis).reshape(-1)),
                    pa.array(np.tile(explained, len(at))),
                    pa.array(np.full(len(at) * k, identity_error))], names=schema.names)

    return vectors.mapInArrow(rows, schema)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 32 whitened components of every whole vector of ``embeddings``."""
    return whiten(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", components=32)
