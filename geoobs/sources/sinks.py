"""Sinks: stores of flux, gas and ocean facts, raster partitions and small exports.

The files of one site, station or deployment may arrive in any number of batches. Rows carry the file
they come from (``source_file``), and a file that comes again replaces its rows. The three stores only
append (``versions``); raster tiles are replaced within the days that a batch touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean
from ..operators.joins import last_row_wins
from ..operators.keys import join_null_safe
from .versions import Store, path_exists

RASTER_PARTITIONS = ["year", "month", "date"]


def replace_partitions(
    df: DataFrame, path: str, partitions: list[str], sort: list[str] | None = None
) -> None:
    """Overwrite exactly the partitions present in ``df``.

    ``rebalance`` lets adaptive execution split a large partition over several files and merge small
    ones, so one dominant site does not become one task.
    """
    out = df.hint("rebalance", *partitions)
    if sort:
        out = out.sortWithinPartitions(*partitions, *sort)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *partitions
    ).parquet(path)


def stored_partitions(df: DataFrame, path: str, partitions: list[str]) -> DataFrame | None:
    """Stored rows of the partitions that ``df`` touches, or None before the first write."""
    spark = df.sparkSession
    if not path_exists(spark, path):
        return None
    stored = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    return join_null_safe(stored, df.select(*partitions).distinct(), partitions, "left_semi")


def flux_store(path: str) -> Store:
    """Flux facts by site; sensor profiles lie apart from the main products."""
    return Store(path, "site_id", ["freq", "product_group", "site_id"], ["variable", "ts_start"])


def gas_store(path: str) -> Store:
    return Store(path, "station_id", ["gas", "station_id"], ["time"])


def ocean_store(path: str) -> Store:
    return Store(path, "deployment", ["deployment"], ["variable", "time"])


def write_flux(df: DataFrame, path: str) -> None:
    group = F.when(F.upper("product").contains("METEOSENS"), "meteosens").otherwise("main")
    flux_store(path).append(df.withColumn("product_group", group))


def write_gas(df: DataFrame, path: str) -> None:
    """A file is replaced within its station."""
    gas_store(path).append(df)


def write_ocean(df: DataFrame, path: str) -> None:
    """A file is replaced within its deployment."""
    ocean_store(path).append(df)


def write_tiles(df: DataFrame, path: str, file: str = "file") -> None:
    """Tiles by date; of a tile that comes again, now or before, the one of the last file stays."""
    keys = ["date", "tile_row", "tile_col"]
    dated = df.withColumns({"year": F.year("date"), "month": F.month("date")})
    stored = stored_partitions(dated, path, RASTER_PARTITIONS)
    if stored is not None:
        dated = dated.unionByName(stored)
    rest = [c for c in dated.columns if c not in keys]
    replace_partitions(
        last_row_wins(dated, keys, [file], rest), path, RASTER_PARTITIONS,
        ["tile_row", "tile_col"],
    )


def store_months(df: DataFrame, path: str, overwrite: bool = False, file: str = "file") -> None:
    """Tiles of whole months: a month that is stored already is skipped, or replaced on request."""
    dated = df.withColumns({"year": F.year("date"), "month": F.month("date")})
    if path_exists(df.sparkSession, path):
        stored = df.sparkSession.read.schema(dated.schema).parquet(path)
        months = stored.select("year", "month").distinct()
        if not overwrite:
            dated = dated.join(months, ["year", "month"], "left_anti")
        else:
            # Days that the month no longer has must go too, so they are written without tiles.
            touched = dated.select("year", "month").distinct()
            _drop_days(stored.join(touched, ["year", "month"], "left_semi"), path)
    keys = ["date", "tile_row", "tile_col"]
    rest = [c for c in dated.columns if c not in keys]
    replace_partitions(
        last_row_wins(dated, keys, [file], rest), path, RASTER_PARTITIONS,
        ["tile_row", "tile_col"],
    )


def _drop_days(days: DataFrame, path: str) -> None:
    """Remove the folders of the dates in ``days``: one row a day of the replaced months."""
    spark = days.sparkSession
    for r in days.select(*RASTER_PARTITIONS).distinct().collect():
        at = spark._jvm.org.apache.hadoop.fs.Path(
            f"{path}/year={r['year']}/month={r['month']}/date={r['date']}"
        )
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def export_columns(df: DataFrame, dtypes: dict[str, str]) -> DataFrame:
    """NULLs of the listed columns replaced by the fill value of their external type."""
    return df.withColumns({c: clean.export_fill(c, t) for c, t in dtypes.items()})


def write_wide(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Tidy table: one row per time, one column per station."""
    df.write.mode("overwrite").format(fmt).option("header", "true").save(path)


def write_passports(documents: DataFrame, path: str) -> None:
    """One text row per document, keyed by the first digits of its checksum.

    The checksum is the identity of a document, so one that is stored already is not stored again.
    """
    from ..operators.passport import file_name

    named = documents.dropDuplicates(["sha256"]).select(
        file_name("sha256").alias("file_name"), "sha256", "document"
    )
    if path_exists(named.sparkSession, path):
        old = named.sparkSession.read.schema(named.schema).json(path).select("sha256")
        named = named.join(old, "sha256", "left_anti").select("file_name", "sha256", "document")
    named.write.mode("append").json(path)
