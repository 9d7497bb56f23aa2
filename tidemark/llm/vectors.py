"""Vectors between Spark's arrays and numpy's matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """Whether a vector is there and all its components are numbers, none of them infinite or not a number."""
    sound = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & F.coalesce(sound, F.lit(False))


def kept(df: DataFrame, vector: str) -> DataFrame:
    """vec_id as long and the vector's components as they are stored, single or double; of finite vectors only."""
    single = df.schema[vector].dataType.simpleString() == "array<float>"
    named = df.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<float>" if single else "array<double>").alias("vector")
    )
    return named.where(finite("vector"))


def matrix(column: pa.Array, width: int, kind: type = np.float64) -> np.ndarray:
    """One row for each vector; a shorter one ends with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype=kind)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def unpacked(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """A matrix from a column of rows, each the bytes of ``width`` numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    if not len(column) or not width:
        return np.zeros((len(column), width), dtype=kind)
    raw = memoryview(column.buffers()[2])[offsets[0] : offsets[-1]]
    return np.frombuffer(raw, dtype=kind).reshape(len(column), width)


def packed(rows: np.ndarray) -> pa.Array:
    """The same bytes, one value for each row."""
    rows = np.ascontiguousarray(rows)
    size = rows.itemsize * rows.shape[1]
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(size)
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])
