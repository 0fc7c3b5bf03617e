"""Vectors as rows of integers, for the operators that compute exactly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components become whole multiples of 1/SCALE; integers beyond LIMIT are set to it, so that sums of squares stay exact.
SCALE, LIMIT = 256, 2**24


def usable(vector: str) -> Column:
    """True for a vector that is not null and holds no null or non-finite component."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & ~odd, F.lit(False))


def finite_rows(vectors: DataFrame, id_col: str, vector_col: str, *more: Column) -> DataFrame:
    """Rows ``(vec_id, v, *more)`` of the usable vectors, components as doubles."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), *more)
    return rows.where(usable("v"))


def longest(rows: DataFrame) -> int:
    """Components of the longest vector; 0 for an empty table."""
    return rows.agg(F.max(F.size("v"))).first()[0] or 0


def integers(lists: pa.ListArray, width: int) -> np.ndarray:
    """floor(SCALE * x) of each component, as rows of ``width`` long integers; shorter vectors end in zeros."""
    ends = lists.offsets.to_numpy()
    sizes = np.diff(ends)
    flat = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False))
    flat = np.clip(flat, -LIMIT, LIMIT).astype(np.int64)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out
