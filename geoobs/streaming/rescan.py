"""Repeated scans of an inventory as a stream of changes.

Every tick of the stream lists the inventory again. The listing is kept as a version of its own and
compared with the version before, so each change is reported once, by the scan that found it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import join_null_safe
from ..sources.versions import path_exists


def _version(path: str, n: int) -> str:
    return f"{path}/listings/version={n}"


def changes(before: DataFrame, now: DataFrame, keys: list[str], state: list[str]) -> DataFrame:
    """``keys`` with ``change``: added, removed, or changed where a ``state`` column differs.

    Entries are compared by all keys, nulls included; an entry listed twice counts once.
    """
    a = before.groupBy(*keys).agg(F.max(F.struct(F.lit(0), *state)).alias("_old"))
    b = now.groupBy(*keys).agg(F.max(F.struct(F.lit(0), *state)).alias("_new"))
    gone = join_null_safe(a, b.select(*keys), keys, "left_anti").select(
        *keys, F.lit("removed").alias("change"))
    new = join_null_safe(b, a.select(*keys), keys, "left_anti").select(
        *keys, F.lit("added").alias("change"))
    both = join_null_safe(a, b, keys).filter(~F.col("_old").eqNullSafe(F.col("_new"))).select(
        *keys, F.lit("changed").alias("change"))
    return gone.unionByName(new).unionByName(both)


def scanner(
    listing: Callable[[DataFrame], DataFrame], path: str, keys: list[str], state: list[str]
) -> Callable[[DataFrame, int], None]:
    """Batch writer: lists the inventory with ``listing(batch)`` and appends what changed since the last
    scan to ``path/changes``, by ``scan``.

    A scan that is repeated after a failure overwrites its own listing and changes, so nothing is
    reported twice.
    """

    def scan(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        listing(batch).select(*keys, *state).write.mode("overwrite").parquet(
            _version(path, batch_id))
        now = spark.read.parquet(_version(path, batch_id))
        last = batch_id - 1
        before = (
            spark.read.schema(now.schema).parquet(_version(path, last))
            if path_exists(spark, _version(path, last)) else now.filter("false")
        )
        changes(before, now, keys, state).write.mode("overwrite").parquet(
            f"{path}/changes/scan={batch_id}")

    return scan


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """All changes with the ``scan`` that found them."""
    return spark.read.parquet(f"{path}/changes")


def forget(spark: SparkSession, path: str, before: int) -> int:
    """Deletes listings older than version ``before``; the one of the last scan must stay. Returns how
    many were deleted."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/listings")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [s.getPath() for s in fs.listStatus(at)
           if int(s.getPath().getName().split("=")[1]) < before]
    for p in old:
        fs.delete(p, True)
    return len(old)
