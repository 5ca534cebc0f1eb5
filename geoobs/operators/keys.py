"""Joins on keys that may be NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner"):
    """Equi join in which a NULL key meets a NULL key; the keys of ``left`` are kept.

    Spark still plans it as a hash or merge join, so rows of a series without a name are not lost.
    """
    renamed = {k: f"_key_{i}" for i, k in enumerate(keys)}
    other = right.withColumnsRenamed(renamed)
    on = reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(other[new]) for k, new in renamed.items()]
    )
    return left.join(other, on, how).drop(*renamed.values())
