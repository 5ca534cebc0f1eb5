"""Incremental ingest, resampling and duplicate removal on streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import shared_dir
from ..sources import sinks
from ..sources.versions import Store
from .report import LATE, counted


def read_landing(
    spark: SparkSession, folder: str, schema, fmt: str = "parquet", pattern: str | None = None,
    **options: str,
) -> DataFrame:
    """Files of a landing folder as a stream; the checkpoint remembers which were read."""
    reader = spark.readStream.format(fmt).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(folder)


def start(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run all available input through ``write`` in micro-batches, then stop."""
    return (
        df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def run_to_table(df: DataFrame, purpose: str, report: list | None = None) -> DataFrame:
    """Append-mode stream written to the shared folder until its input is used up, then read back.

    Rows left out are counted over all micro-batches: ``report`` gets an entry (status, reason, rows)
    for ``ingest_report`` and for each reason that ``report.observed`` was asked to count.
    """
    spark = df.sparkSession
    path, checkpoint = shared_dir(spark, purpose), shared_dir(spark, f"{purpose}-state")
    with counted(spark) as counts:
        query = (
            df.writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        if report is not None:
            counts.wait(query)
            report.append(("skipped", LATE, counts.total(query)))
            others = counts.rows(spark, query).filter(F.col("reason") != LATE)
            for r in others.groupBy("reason").agg(F.sum("n_rows").alias("n")).collect():
                report.append(("skipped", r["reason"], r["n"]))
    return spark.read.schema(df.schema).parquet(path)


def append_to(store: Store) -> Callable:
    """Batch writer that adds its rows to a store; files that come again replace what they brought.

    A batch costs what its own rows weigh. A retried batch gives the same table, and so do batches of
    different files in any other order.
    """
    return lambda batch, _: store.append(batch)


def writer(write_batch: Callable[[DataFrame, str], None], path: str) -> Callable:
    """Batch writer around one of the sinks: ``write_flux``, ``write_gas``, ``write_ocean``."""
    return lambda batch, _: write_batch(batch, path)


def append_days(path: str) -> Callable:
    """Batch writer of raster tiles: tiles of the last file win, whatever batch brings them.

    Dates are partitions, so only tiles of the dates in a batch are read back.
    """

    def write(batch: DataFrame, _: int) -> None:
        sinks.write_tiles(batch, path)

    return write


def tumbling_mean(
    df: DataFrame, keys: list[str], ts: str, value: str, period: str = "1 day",
    delay: str | None = None,
) -> DataFrame:
    """Mean and count per period; a period is emitted once the watermark has passed it."""
    return df.withWatermark(ts, delay or period).groupBy(*keys, F.window(ts, period).alias("w")).agg(
        F.avg(value).alias("mean_value"), F.count(value).alias("n_obs")
    ).select(*keys, F.col("w.start").alias("period_start"), "mean_value", "n_obs")


def first_per_key(df: DataFrame, keys: list[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """Rows whose key was not seen within the watermark delay."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)
