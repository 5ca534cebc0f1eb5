"""Space and time as one sort key, so that boxes skip files and row groups.

The key interleaves the bits of latitude, longitude and time (a Z-order curve). Rows that are near in
all three lie together, whatever deployment they come from, and the smallest and largest values that
Parquet keeps for each row group are narrow in each of them. A box is then an ordinary filter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import micros

# Bits of each coordinate; 3 x 20 fit into a long.
BITS = 20
ROWS_PER_FILE = 1_000_000


def _cell(c: Column, low: Column, high: Column) -> Column:
    """Position between ``low`` and ``high`` as a whole number of ``BITS`` bits; null counts as lowest."""
    share = (c.cast("double") - low) / F.when(high > low, high - low).otherwise(F.lit(1.0))
    top = (1 << BITS) - 1
    return F.coalesce(F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * top), F.lit(0))


def z_key(lat: Column, lon: Column, time_us: Column, first_us: Column, last_us: Column) -> Column:
    """Z-order key of a place and a time between ``first_us`` and ``last_us``."""
    cells = [
        _cell(time_us, first_us, last_us),
        _cell(lon, F.lit(-180.0), F.lit(180.0)), _cell(lat, F.lit(-90.0), F.lit(90.0)),
    ]
    key = F.lit(0).cast("bigint")
    for b in range(BITS):
        for k, cell in enumerate(cells):
            bit = F.shiftright(cell.cast("bigint"), b).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(bit, 3 * b + k))
    return key


def write_by_place(
    df: DataFrame, path: str, lat: str = "lat", lon: str = "lon", ts: str = "time",
    rows_per_file: int = ROWS_PER_FILE, rows_per_group: int = 100_000,
) -> None:
    """Rows in files by ranges of their key, ordered by it, in row groups of about ``rows_per_group``.

    The span of times is one row of the data. Rows without a place or a time lie at the lower end.
    """
    us = micros(ts)
    first, last, n = df.agg(F.min(us), F.max(us), F.count("*")).first()
    span = [F.lit(float(x if x is not None else 0)) for x in (first, last)]
    keyed = df.withColumn("_z", z_key(F.col(lat), F.col(lon), us, *span))
    files = max(1, math.ceil(n / rows_per_file))
    keyed.repartitionByRange(files, "_z").sortWithinPartitions("_z").drop("_z").write.option(
        # Spark's writer sizes row groups in bytes; a row of facts weighs about 64 of them.
        "parquet.block.size", str(64 * rows_per_group)
    ).option("parquet.page.row.count.limit", "20000").parquet(path)


def in_box(
    df: DataFrame, south: float, north: float, west: float, east: float,
    lat: str = "lat", lon: str = "lon",
) -> DataFrame:
    """Rows of a box, bounds included; ``west`` beyond ``east`` crosses the date line."""
    inside = F.col(lat).between(south, north)
    if west <= east:
        return df.filter(inside & F.col(lon).between(west, east))
    return df.filter(inside & ((F.col(lon) >= west) | (F.col(lon) <= east)))
