"""Vectors as whole numbers, so that distances and products are exact on every machine."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Whole components lie inside plus and minus this: sums of thousands of their products fit a long.
LIMIT = 1 << 24


def _usable(vector: Column, scale: int) -> Column:
    """No component is null, not a number, infinite or beyond ``LIMIT`` once scaled."""
    return F.coalesce(vector.isNotNull() & F.forall(
        vector, lambda x: F.coalesce((F.abs(x.cast("double")) * scale < LIMIT) & ~F.isnan(x), F.lit(False))), F.lit(False))


def whole_vectors(rows: DataFrame, scale: int, dimensions: int | None = None, columns: tuple = ()) -> DataFrame:
    """(vec_id, ``columns``, v: array<int>) with floor(scale * x) of every component x of ``embedding``.

    Rows whose vector is null, has an unusable component or, where ``dimensions`` is
    given, another size are left out.
    """
    good = _usable(F.col("embedding"), scale)
    if dimensions is not None:
        good &= F.size("embedding") == dimensions
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("int"))
    return rows.filter(good).select(F.col("vec_id").cast("long").alias("vec_id"), *columns, whole.alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows of ``width``; shorter lists are filled up with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The rows of a matrix as lists."""
    offsets = np.arange(0, rows.size + 1, max(rows.shape[1], 1), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel(), kind))
