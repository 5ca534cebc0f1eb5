"""Landed atmospheric gas rows to the station fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import clean, names
from ..operators import aggregates


def to_facts(
    rows: DataFrame, file: str = "file_name", units: dict[str, str] | None = None
) -> DataFrame:
    """Rows keyed by gas and station, values in ppm or ppb, redundant time columns dropped.

    ``units`` names the unit column of each further mole-fraction column; only rows in mol mol-1 are
    rescaled. Rows of files whose name is not understood have no gas or station and are left out;
    ``unparsed_files`` lists them for the ingest report.
    """
    info = names.parse_gas_name(file)
    out = rows.withColumn("_p", info).filter(F.col("_p.gas").isNotNull()).withColumns({
        "gas": F.col("_p.gas"), "station_id": F.col("_p.station_id"),
        "trigram": F.upper("_p.trigram"), "height": F.coalesce("_p.height", F.lit(0)),
    })
    out = out.withColumn("value", clean.rescale_gas("value", "gas"))
    for column, unit in (units or {}).items():
        out = out.withColumn(column, clean.rescale_gas(column, "gas", unit))
    return out.withColumn("unit", clean.gas_unit("gas")).drop("_p", *S.REDUNDANT_TIME_COLUMNS)


def unparsed_files(rows: DataFrame, file: str = "file_name") -> DataFrame:
    """Files whose name gives no gas, with their rows, as skipped entries of an ingest report."""
    bad = rows.withColumn("_p", names.parse_gas_name(file)).filter(F.col("_p.gas").isNull())
    return bad.groupBy(F.col(file).alias("file")).agg(F.count("*").alias("n_rows")).select(
        "file", F.lit("skipped").alias("status"), F.lit("file name not understood").alias("reason"),
        "n_rows",
    )


def station_constants(facts: DataFrame, candidates: list[str] | None = None) -> DataFrame:
    """(station_id, gas, name, text): columns that hold one value, to be kept as attributes."""
    columns = [c for c in candidates or S.STATIC_CANDIDATES if c in facts.columns]
    found = aggregates.constant_columns(facts, ["station_id", "gas"], columns)
    return found.filter("is_constant").select(
        "station_id", "gas", F.col("column").alias("name"), F.col("value").alias("text")
    )


def wide_names(columns: list[str], gas: str) -> dict[str, str]:
    """Column names of a wide export: the value takes the gas name, the rest its prefix."""
    out = {}
    for c in columns:
        if c == "value":
            out[c] = gas
        elif c.startswith("value_"):
            out[c] = c.replace("value", gas, 1)
        elif c != gas and not c.startswith(f"{gas}_"):
            out[c] = f"{gas}_{c}"
    return out


def wide_export(facts: DataFrame, gas: str, keys: list[str]) -> DataFrame:
    """Rows of one gas with gas-prefixed columns, as array stores name them."""
    one = facts.filter(F.col("gas") == gas).drop("gas")
    renamed = wide_names([c for c in one.columns if c not in (*keys, "time")], gas)
    return one.withColumnsRenamed({**renamed, "time": f"time_{gas}"})
