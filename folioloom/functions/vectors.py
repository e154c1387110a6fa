"""Vector expressions over array columns, and numpy views of Arrow list columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bounds that keep empty masks and zero vectors from dividing by zero.
MIN_COUNT = 1e-9
MIN_NORM = 1e-12


def l2_normalize(vector: Column) -> Column:
    """Unit length in double precision; the zero vector stays zero."""
    wide = vector.cast("array<double>")
    squares = F.aggregate(wide, F.lit(0.0), lambda acc, x: acc + x * x)
    # one array element, so that the norm is worked out once per row, not once per component
    return F.flatten(F.transform(
        F.array(F.greatest(F.sqrt(squares), F.lit(MIN_NORM))),
        lambda norm: F.transform(wide, lambda x: x / norm),
    ))


def masked_mean_pool(hidden: Column, mask: Column) -> Column:
    """Mean of the token vectors whose mask is 1; ``hidden`` is array<array<double>>."""
    kept = F.transform(
        F.filter(F.arrays_zip(hidden.alias("h"), mask.alias("m")), lambda t: t["m"] != 0),
        lambda t: t["h"],
    )
    zero = F.transform(F.element_at(hidden, 1), lambda x: F.lit(0.0))
    total = F.aggregate(kept, zero, lambda acc, h: F.zip_with(acc, h, lambda a, b: a + b))
    count = F.greatest(F.aggregate(mask, F.lit(0.0), lambda acc, m: acc + m), F.lit(MIN_COUNT))
    return F.transform(total, lambda x: x / count)


def squared_l2(a: Column, b: Column) -> Column:
    terms = F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y))
    return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)


def vector_ok(vector: Column, dim: Column | int) -> Column:
    """True for a vector of ``dim`` components, none of them null or NaN."""
    dim = dim if isinstance(dim, Column) else F.lit(dim)
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x))
    return F.coalesce(vector.isNotNull() & (F.size(vector) == dim) & whole, F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, dtype=np.float32) -> np.ndarray:
    """N x D view of a list column whose rows all have the same length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if rows and (len(values) % rows or not np.all(np.diff(column.offsets.to_numpy()) == len(values) // rows)):
        raise ValueError("vectors of one column differ in length")
    return np.ascontiguousarray(values.reshape(rows, -1) if rows else values.reshape(0, 0), dtype=dtype)


def list_column(values: np.ndarray) -> pa.ListArray:
    """Arrow list column of the rows of a matrix."""
    rows, dim = values.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * dim)
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))
