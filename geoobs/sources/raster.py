"""Daily raster catalogue and tile tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import raster
from .. import schema as S


def catalogue(files: DataFrame, path: str, first: str | None = None, last: str | None = None):
    """Files named GPP_yyyy_MM_dd.tif with a valid date in first..last (inclusive)."""
    base = F.element_at(F.split(F.col(path), "/"), -1)
    text = F.regexp_extract(base, r"(?i)^GPP_(\d{4}_\d{2}_\d{2})\.tif$", 1)
    out = files.withColumn("date", F.try_to_timestamp(text, F.lit("yyyy_MM_dd")).cast("date"))
    out = out.filter(F.col("date").isNotNull())
    if first:
        out = out.filter(F.col("date") >= F.lit(first).cast("date"))
    if last:
        out = out.filter(F.col("date") <= F.lit(last).cast("date"))
    return out


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of a landing folder; file contents are not read."""
    return spark.read.format("binaryFile").load(folder).select("path", "length")


def encode_tiles(tiles: DataFrame, lossless: bool = False) -> DataFrame:
    """Tiles of raw counts to storage counts with their scale."""
    scale = S.RASTER_RAW_SCALE if lossless else S.RASTER_SCALE
    return tiles.withColumn("data", raster.quantise("data", lossless)).withColumn(
        "scale", F.lit(scale)
    )


def tile_coordinates(tiles: DataFrame, transform: DataFrame, size: int) -> DataFrame:
    """Coordinates of the first pixel centre of each tile; pixels follow by the grid step.

    The geotransform is one row and rides along as a constant key.
    """
    g = F.broadcast(transform.withColumn("_one", F.lit(1)))
    out = tiles.withColumn("_one", F.lit(1)).join(g, "_one").drop("_one")
    return out.withColumns({
        "lon0": raster.centre("x0", "dx", F.col("tile_col") * size),
        "lat0": raster.centre("y0", "dy", F.col("tile_row") * size),
    })


def missing_months(incoming: DataFrame, stored: DataFrame, overwrite: bool = False) -> DataFrame:
    """Incoming rows of months the store does not have yet, or all of them on overwrite."""
    if overwrite:
        return incoming
    m = stored.select(
        F.year("date").alias("_y"), F.month("date").alias("_m")
    ).distinct()
    hit = (F.year(incoming["date"]) == m["_y"]) & (F.month(incoming["date"]) == m["_m"])
    return incoming.join(m, hit, "left_anti")
