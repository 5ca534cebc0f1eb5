"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        candidate, n = f"_{name}", 0
        while candidate.lower() in taken:
            n += 1
            candidate = f"_{name}_{n}"
        taken.add(candidate.lower())
        out.append(candidate)
    return out


def col(name: str) -> Column:
    """A column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def replace_columns(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with output columns added; input columns of the same name are replaced."""
    taken = {c.lower() for c in columns}
    keep = [col(c) for c in df.columns if c.lower() not in taken]
    return df.select(*keep, *[c.alias(name) for name, c in columns.items()])


def bytes_of(name: str) -> Column:
    """UTF-8 bytes of a text column; a null text counts as the empty text."""
    return F.coalesce(col(name).cast("string"), F.lit("")).cast("binary")


def rows_of(batch: pa.Array, step: int = 256) -> Iterator[bytes]:
    """Values of an array, a few at a time, so that a batch is not held twice."""
    for at in range(0, len(batch), step):
        yield from batch.slice(at, step).to_pylist()


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below the shared folder and read back.

    This cuts the lineage: what follows reads files that every executor reaches, so a lost executor
    costs only its running tasks.
    """
    spark: SparkSession = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
