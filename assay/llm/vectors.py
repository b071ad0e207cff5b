"""Whole-number vectors for the exact clustering and coding operators."""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(e: Column) -> Column:
    """Whether an array of doubles is there and holds neither nulls nor non-finite components."""
    return e.isNotNull() & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def whole(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, one row a vector; an error where squared distances would not fit in 62 bits."""
    x = np.floor(np.asarray(column.flatten(), dtype="<f8").reshape(-1, dims) * scale)
    most = isqrt(2**62 // max(dims, 1)) // 2
    if len(x) and not np.abs(x).max() < most:
        raise OverflowError(f"components times {scale} must stay below {most} in size for exact distances of {dims} dimensions")
    return x.astype(np.int64)


def binary(x: np.ndarray, kind: str) -> pa.Array:
    """One binary value a row."""
    x = np.ascontiguousarray(x.astype(kind))
    width = x.shape[1] * x.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(x), [None, pa.py_buffer(x.tobytes())]).cast(pa.binary())


def rows(column: pa.Array, kind: str) -> np.ndarray:
    """The matrix of a column that ``binary`` made; columns follow from the first value."""
    n = len(column)
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, kind).reshape(n, -1) if n else np.zeros((0, 0), kind)
