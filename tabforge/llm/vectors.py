"""Integer codes of embedding vectors, shared by clustering and whitening."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 64.0  # a component c becomes floor(64 * c)


def is_finite(vector: Column) -> Column:
    """The vector is there and holds no null and no non-finite entry."""
    clean = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))  # NaN sorts above infinity
    return F.coalesce(vector.isNotNull() & clean, F.lit(False))


def codes(vector: Column, bound: float, offset: int = 0) -> Column:
    """array<long> of floor(64 * c) + offset; products beyond ``bound`` are held at it."""
    def code(c: Column) -> Column:
        scaled = c.cast("double") * F.lit(SCALE)
        return F.floor(F.greatest(F.least(scaled, F.lit(float(bound))), F.lit(-float(bound)))) + F.lit(offset).cast("long")
    return F.transform(vector, code)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The rows of an Arrow list column of ``dims`` longs as an int64 matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), dims)


def list_column(rows: np.ndarray) -> pa.Array:
    """A matrix as an Arrow list column."""
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width, pa.int32()), pa.array(rows.ravel()))
