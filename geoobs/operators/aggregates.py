"""Summaries of stations, deployments, products and catalogues. All combine map-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import join_null_safe

from .. import schema as S
from ..functions.clean import micros, slot_start


def station_summary(df: DataFrame, station: str, value: str, *coords: str) -> DataFrame:
    """Non-missing count and mean per station; coordinates are constant per station."""
    return df.groupBy(station, *coords).agg(
        F.count(value).alias("n_obs"), F.avg(value).alias("mean_value")
    )


def pooled_summary(df: DataFrame, value: str) -> DataFrame:
    return df.agg(
        F.avg(value).alias("mean_value"), F.min(value).alias("min_value"),
        F.max(value).alias("max_value"), F.count(value).alias("n_obs"),
    )


def mean_by(df: DataFrame, keys: list[str], value: str, name: str = "mean_value") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(name))


def constant_columns(df: DataFrame, keys: list[str], candidates: list[str]) -> DataFrame:
    """(key, column, is_constant, value): columns with one value, or none at all, per key."""
    total = F.count("*")
    items = []
    for c in candidates:
        col = F.col(c)
        same = (F.count(col) == 0) | ((F.count(col) == total) & (F.min(col) == F.max(col)))
        items.append(
            F.struct(
                F.lit(c).alias("column"), same.alias("is_constant"),
                F.when(same, F.min(col).cast("string")).alias("value"),
            )
        )
    packed = df.groupBy(*keys).agg(F.array(*items).alias("_i"))
    return packed.select(*keys, F.explode("_i").alias("_c")).select(*keys, "_c.*")


def is_fixed(geo_type: Column, lon: str, lat: str, limit: float = 0.001) -> Column:
    """Aggregate expression: catalogue geometry first, then the spread of the positions."""
    geo = F.lower(F.coalesce(F.first(geo_type, ignorenulls=True), F.lit("")))
    still = (F.coalesce(F.stddev_pop(lon), F.lit(0.0)) < limit) & (
        F.coalesce(F.stddev_pop(lat), F.lit(0.0)) < limit
    )
    return (
        F.when(geo == "point", True)
        .when(geo.isin("linestring", "multilinestring", "polygon"), False)
        .otherwise(still)
    )


def fixed_deployments(df, key="deployment", lon="lon", lat="lat", geo_type="geo_type"):
    return df.groupBy(key).agg(is_fixed(F.col(geo_type), lon, lat).alias("fixed"))


def static_position(df: DataFrame, key: str, lon: str, lat: str) -> DataFrame:
    """Exact median position per deployment; both coordinates go through one pass."""
    from .percentiles import exact_percentiles

    axes = F.explode(F.array(*[
        F.struct(F.lit(name).alias("axis"), F.col(c).alias("at"))
        for name, c in (("static_lon", lon), ("static_lat", lat))
    ]))
    cells = df.select(key, axes.alias("_a")).select(key, "_a.*")
    medians = exact_percentiles(cells, [key, "axis"], "at", {"median": 0.5})
    return medians.groupBy(key).agg(*[
        F.max(F.when(F.col("axis") == name, F.col("median"))).alias(name)
        for name in ("static_lon", "static_lat")
    ])


def common_variables(df: DataFrame, station: str, variable: str) -> DataFrame:
    """Variables every station has."""
    pairs = df.select(station, variable).distinct()
    n = pairs.agg(F.count_distinct(station).alias("_n")).withColumn("_one", F.lit(1))
    per = pairs.groupBy(variable).agg(F.count("*").alias("n_stations")).withColumn("_one", F.lit(1))
    # One row, joined on a constant; variables are a bounded vocabulary.
    return per.join(F.broadcast(n), "_one").filter("n_stations = _n").select(variable, "n_stations")


def shared_names(mapping: DataFrame, name: Column) -> DataFrame:
    """Normalised names found in more than one product."""
    return (
        mapping.select(name.alias("name"), "product").distinct().groupBy("name")
        .agg(F.count("*").alias("n_products")).filter("n_products > 1")
    )


def coverage(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """First and last time and the whole days between them."""
    out = df.groupBy(*keys).agg(F.min(ts).alias("start"), F.max(ts).alias("stop"))
    days = F.floor((micros("stop") - micros("start")) / 86_400_000_000)
    return out.withColumn("duration_days", days.cast("bigint"))


def canonical_gases(gas: str) -> Column:
    """Aggregate expression: the gases present, in canonical order (at most four entries)."""
    seen = F.collect_set(gas)
    return F.filter(
        F.array(*[F.lit(g) for g in S.GASES]), lambda g: F.array_contains(seen, g)
    )


def site_rollup(df: DataFrame, site: str, height: str, gas: str) -> DataFrame:
    """Gases per site and height, and the union of gases per site, as one row per height."""
    pairs = df.select(site, height, gas).distinct()
    per_height = pairs.groupBy(site, height).agg(canonical_gases(gas).alias("gases"))
    per_site = pairs.groupBy(site).agg(
        canonical_gases(gas).alias("site_gases"), F.count_distinct(height).alias("n_heights")
    )
    return per_height.join(per_site, site)


def platform_catalogue(deployments: DataFrame) -> DataFrame:
    """Deployments under their platform, one row each, numbered by start.

    Platform is the station id, else the platform name, else "(unknown)". The catalogue stays in
    rows: sorted by (platform, start) it reads as the nested list would, without gathering one.
    """
    platform = F.coalesce(
        F.nullif(F.col("station_id"), F.lit("")), F.nullif(F.col("platform_name"), F.lit("")),
        F.lit("(unknown)"),
    )
    return deployments.select(
        platform.alias("platform"), "deployment", "time_start", "time_end", "fixed", "n_rows"
    ).orderBy("platform", "time_start", "deployment")


def slot_means(df: DataFrame, keys: list[str], ts: str, value: str, unit: str, name: str):
    """Mean per calendar slot (DAY, MONTH, ...), NULL when nothing was observed."""
    return df.groupBy(*keys, slot_start(ts, unit).alias(name)).agg(
        F.avg(value).alias("mean_value"), F.count(value).alias("n_obs")
    )


def trend(df: DataFrame, station: str, index: Column, value: str, per: float = 365.0):
    """Least-squares slope per year over a daily series, missing days left out."""
    x = F.when(F.col(value).isNotNull(), index)
    return df.groupBy(station).agg((F.regr_slope(value, x) * per).alias("trend_per_year"))


def seasonal_extremes(daily: DataFrame, station: str, day: str, value: str, prefer: int = 2022):
    """Winter maximum and summer minimum of one calendar year per station.

    The year is ``prefer`` when the series covers it, else the year with the most days.
    """
    years = daily.groupBy(station, F.year(day).alias("ref_year")).agg(F.count("*").alias("_n"))
    rank = F.struct(
        (F.col("ref_year") != prefer).alias("a"), (-F.col("_n")).alias("b"), F.col("ref_year")
    )
    ref = years.groupBy(station).agg(F.min_by("ref_year", rank).alias("ref_year"))
    rows = daily.join(ref, station).filter(F.year(day) == F.col("ref_year"))
    v, winter = F.col(value), F.month(day).isin(12, 1, 2) & F.col(value).isNotNull()
    summer = F.month(day).isin(6, 7, 8) & v.isNotNull()
    hi = F.min_by(F.struct(day, value), F.when(winter, F.struct((-v).alias("a"), F.col(day))))
    lo = F.min_by(F.struct(day, value), F.when(summer, F.struct(v.alias("a"), F.col(day))))
    return rows.groupBy(station, "ref_year").agg(hi.alias("_hi"), lo.alias("_lo")).select(
        station, "ref_year",
        F.col(f"_hi.{day}").alias("winter_day"), F.col(f"_hi.{value}").alias("winter_max"),
        F.col(f"_lo.{day}").alias("summer_day"), F.col(f"_lo.{value}").alias("summer_min"),
    )


def coverage_percent(df: DataFrame, station: str, value: str) -> DataFrame:
    """Share of filled slots and the value range per station."""
    return df.groupBy(station).agg(
        F.count("*").alias("n_slots"), F.count(value).alias("n_obs"),
        (100 * F.count(value) / F.count("*")).alias("coverage_pct"),
        F.min(value).alias("min_value"), F.max(value).alias("max_value"),
    )


def flag_sets(df: DataFrame, station: str, flag: str) -> DataFrame:
    """Distinct flags per station (flags are a small fixed alphabet)."""
    return df.groupBy(station).agg(F.sort_array(F.collect_set(flag)).alias("flags"))


def extents(df: DataFrame, station: str, ts: str) -> DataFrame:
    return df.agg(
        F.count_distinct(station).alias("n_stations"), F.min(ts).alias("time_min"),
        F.max(ts).alias("time_max"),
    )


def viewport(df: DataFrame, keys: list[str], lon: str, lat: str) -> DataFrame:
    """Box around a track with max(2 deg, 10 %) / max(1 deg, 10 %) padding, and its centre."""
    box = df.groupBy(*keys).agg(
        F.min(lon).alias("west"), F.max(lon).alias("east"), F.min(lat).alias("south"),
        F.max(lat).alias("north"),
    )
    pad_lon = F.greatest(F.lit(2.0), (F.col("east") - F.col("west")) * 0.10)
    pad_lat = F.greatest(F.lit(1.0), (F.col("north") - F.col("south")) * 0.10)
    return box.select(
        *keys,
        (F.col("west") - pad_lon).alias("west"), (F.col("east") + pad_lon).alias("east"),
        (F.col("south") - pad_lat).alias("south"), (F.col("north") + pad_lat).alias("north"),
        ((F.col("south") + F.col("north")) / 2).alias("centre_lat"),
        ((F.col("west") + F.col("east")) / 2).alias("centre_lon"),
    )


def annual_budget(df: DataFrame) -> DataFrame:
    """NEE, GPP and RECO per site and year from the yearly product (VUT, REF, night-time)."""
    chosen = df.filter(
        (F.col("ustar_threshold") == "VUT") & (F.col("nee_variant") == "REF")
        & (F.col("partition_method").isNull() | (F.col("partition_method") == "NT"))
        & F.col("variable").isin("NEE", "GPP", "RECO")
    )
    picks = [
        F.max(F.when(F.col("variable") == v, F.col("value"))).alias(v.lower())
        for v in ("NEE", "GPP", "RECO")
    ]
    return chosen.groupBy("site_id", F.year("ts_start").alias("year")).agg(*picks)


def files_per_month(df: DataFrame, date: str, size: str) -> DataFrame:
    """Days and bytes of each calendar month."""
    return df.groupBy(F.year(date).alias("year"), F.month(date).alias("month")).agg(
        F.count_distinct(date).alias("n_days"), F.count("*").alias("n_files"),
        F.sum(size).alias("bytes"),
    )


def store_inventory(df: DataFrame, keys: list[str], variable: str, label_columns: list[str]):
    """Rows, label combinations and dimensionality of each variable."""
    combos = df.groupBy(*keys, variable, *label_columns).agg(F.count("*").alias("_n"))
    labelled = [F.count_if(F.col(c).isNotNull()) > 0 for c in label_columns]
    n_dims = sum((flag.cast("int") for flag in labelled), F.lit(1))
    return combos.groupBy(*keys, variable).agg(
        F.sum("_n").alias("n_rows"), F.count("*").alias("n_combos"), n_dims.alias("n_dims")
    )


def log_bins(df: DataFrame, keys: list[str], f: str, power: str, edges: int = 350) -> DataFrame:
    """Mean power in logarithmic frequency bins per group; empty bins have no row."""
    lf = F.log10(F.col(f))
    span = df.groupBy(*keys).agg(F.min(lf).alias("_lo"), F.max(lf).alias("_hi"))
    n = edges - 1
    # A group of one frequency has no width; all of it is the first bin.
    place = F.coalesce(F.try_divide(lf - F.col("_lo"), F.col("_hi") - F.col("_lo")), F.lit(0.0))
    rows = join_null_safe(df, span, keys).withColumn(
        "bin", F.least(F.floor(place * n) + 1, F.lit(n)).cast("int")
    )
    step = (F.col("_hi") - F.col("_lo")) / n
    centre = F.pow(F.lit(10.0), F.col("_lo") + (F.col("bin") - 0.5) * step)
    return rows.groupBy(*keys, "bin", centre.alias("f_centre")).agg(
        F.avg(power).alias("mean_power"), F.count("*").alias("n_freqs")
    )
