"""Raster cell expressions on tiles held as arrays; a full grid is never exploded to pixels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S
from .clean import ColumnLike, _c


def quantise(data: ColumnLike, lossless: bool = False) -> Column:
    """Raw counts (0.001 units) to counts of the coarser output scale, half to even.

    The arithmetic runs in single precision as the raster tools do, so ties fall alike.
    """
    if lossless:
        return F.transform(_c(data), lambda x: x.cast("smallint"))
    nodata = F.lit(S.RASTER_NODATA)

    def cell(x: Column) -> Column:
        scaled = x.cast("float") * F.lit(S.RASTER_RAW_SCALE).cast("float")
        # float / float is evaluated in double by Spark; cast back to keep single precision.
        out = (scaled / F.lit(S.RASTER_SCALE).cast("float")).cast("float")
        return F.when(x == nodata, nodata).otherwise(F.bround(out.cast("double"))).cast("smallint")

    return F.transform(_c(data), cell)


def decode(data: ColumnLike, scale: ColumnLike) -> Column:
    """Physical values of a tile; nodata becomes NULL."""
    s = _c(scale)
    return F.transform(_c(data), lambda x: F.when(x != F.lit(S.RASTER_NODATA), x * s))


def centre(origin: ColumnLike, step: ColumnLike, index: ColumnLike) -> Column:
    """Coordinate of a pixel centre."""
    return _c(origin) + (_c(index) + F.lit(0.5)) * _c(step)
