"""Vectors in Arrow batches: which of them are whole, and their components as integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def float_vector(df, name: str) -> Column:
    """The vector column as an array of floats or doubles; other numbers become doubles."""
    kind = df.schema[name].dataType
    floats = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType))
    return F.col(f"`{name}`") if floats else F.col(f"`{name}`").cast("array<double>")


def whole_vectors(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``rows, starts, lengths, values`` of the vectors that are not null and hold finite entries only."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null entries become NaN
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    whole = bad[offsets[1:]] == bad[offsets[:-1]]
    if column.null_count:
        whole &= column.is_valid().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(whole)
    return rows, offsets[rows], offsets[rows + 1] - offsets[rows], values


def matrix(starts: np.ndarray, lengths: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
    """Vectors as rows of a matrix; shorter ones are filled with zeros."""
    columns = np.arange(width)
    if (lengths == width).all():
        return values[starts[:, None] + columns]
    out = np.zeros((len(starts), width))
    inside = columns < lengths[:, None]
    out[inside] = values[(starts[:, None] + columns)[inside]]
    return out


def scaled_floor(x: np.ndarray, scale: int, limit: int) -> np.ndarray:
    """``floor(scale * x)`` as longs, cut to ``-limit`` and ``limit``."""
    return np.floor(np.clip(x * float(scale), -limit, limit)).astype(np.int64)
