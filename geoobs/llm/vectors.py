"""Vectors as table columns: which ones count, one for each id, and their matrix form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col


def finite(vector: Column) -> Column:
    """Neither null nor empty, and every component a finite number."""
    whole = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce((F.size(vector) > 0) & whole, F.lit(False))


def nonzero(vector: Column) -> Column:
    return F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def one_per_id(df: DataFrame, vec_id: str, vector: str, usable) -> DataFrame:
    """``id``, ``vector`` (doubles) of the rows that count; of rows with one id the smallest vector.

    Rows without an id or with an unusable vector are left out.
    """
    rows = df.select(
        col(vec_id).cast("long").alias("id"), col(vector).cast("array<double>").alias("vector")
    ).filter(F.col("id").isNotNull() & usable(F.col("vector")))
    return rows.groupBy("id").agg(F.min("vector").alias("vector"))


def by_dimension(column: pa.Array):
    """Row numbers and matrix of the vectors of each dimension in an array of lists."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    size = np.diff(ends)
    for dim in np.unique(size):
        rows = np.flatnonzero(size == dim)
        yield int(dim), rows, flat[ends[rows][:, None] + np.arange(dim)]


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by their largest component first, so nothing under- or
    overflows."""
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
