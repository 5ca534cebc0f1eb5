"""Product merge, scatter on a union time axis, station coordinates and instrument joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import clean, names


def normal_name(column: str | Column) -> Column:
    """Variable name with its _QC / _FLAG suffix removed."""
    col = F.col(column) if isinstance(column, str) else column
    return F.regexp_replace(col, "_(QC|FLAG)$", "")


def duplicate_variables(mapping: DataFrame, strict_names: bool = False) -> DataFrame:
    """Columns whose normalised name occurs in more than one product.

    ``mapping(product, column)`` is header metadata. With ``strict_names`` only literally equal
    names count.
    """
    name = F.col("column") if strict_names else normal_name("column")
    named = mapping.select("product", "column", name.alias("_name"))
    shared = named.groupBy("_name").agg(F.count_distinct("product").alias("_k")).filter("_k > 1")
    return named.join(shared, "_name", "left_semi").select("column").distinct()


def merge_products_long(parts: dict[str, DataFrame], mapping: DataFrame, strict_names=False):
    """Half-hourly products as one long table without the variables several products hold.

    Each part has a ``column`` field naming its source column. The anti join is against header
    metadata (one row per column), so Spark broadcasts it.
    """
    tagged = [df.withColumn("product", F.lit(name)) for name, df in parts.items()]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return union.join(duplicate_variables(mapping, strict_names), "column", "left_anti")


def merge_products_wide(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Products side by side on the union of their key values; shared columns are dropped."""
    data = [[c for c in p.columns if c not in keys] for p in parts]

    def norm(c: str) -> str:
        return c.removesuffix("_QC").removesuffix("_FLAG")

    count: dict[str, int] = {}
    for cols in data:
        for name in {norm(c) for c in cols}:
            count[name] = count.get(name, 0) + 1
    kept = [
        p.select(*keys, *[c for c in cols if count[norm(c)] == 1])
        for p, cols in zip(parts, data)
    ]
    return reduce(lambda a, b: a.join(b, keys, "full_outer"), kept)


def keep_best_product(mapping: DataFrame) -> DataFrame:
    """(freq, variable) -> the product with the best priority; later ties by product name."""
    ranked = F.min_by("product", F.struct(names.product_priority("product"), F.col("product")))
    return mapping.groupBy("freq", "variable").agg(ranked.alias("product"))


def union_times(parts: list[DataFrame], ts: str) -> DataFrame:
    """Distinct timestamps over all inputs."""
    return reduce(lambda a, b: a.union(b), [p.select(ts) for p in parts]).distinct()


def last_row_wins(df: DataFrame, keys: list[str], order: list[str], columns: list[str]):
    """One row per key: the one that comes last in ``order``.

    ``max_by`` combines map-side, so repeated stamps of one series never gather in one task.
    """
    row = F.struct(*columns)
    return df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_r")).select(
        *keys, *[F.col("_r")[c].alias(c) for c in columns]
    )


def first_row_wins(df: DataFrame, keys: list[str], order: list[str], columns: list[str]):
    """One row per key: the one that comes first in ``order``."""
    row = F.struct(*columns)
    return df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_r")).select(
        *keys, *[F.col("_r")[c].alias(c) for c in columns]
    )


def scatter(
    df: DataFrame, station: str, ts: str, value: str, order: list[str], stations: list,
) -> DataFrame:
    """Dense station x union-time cells of one variable; missing cells have a NULL value.

    The dense form multiplies rows by design, so it is built only on request, for a listed station
    axis: each union timestamp holds one map of the stations that observed it and is laid out along
    the axis, without joining stations to times.
    """
    listed = df.filter(F.col(station).isin(stations))
    cells = last_row_wins(listed, [ts, station], order, [value])
    observed = F.map_from_entries(F.collect_list(F.struct(station, value)))
    axis = F.array(*[F.lit(s) for s in stations])
    rows = cells.groupBy(ts).agg(observed.alias("_m"))
    return rows.select(ts, F.explode(axis).alias(station), "_m").select(
        station, ts, F.try_element_at("_m", F.col(station)).alias(value)
    )


def with_station(facts: DataFrame, dim: DataFrame, key: str, *columns: str) -> DataFrame:
    """Station columns on facts; facts without a station keep NULLs."""
    return facts.join(dim.select(key, *columns), key, "left")


def with_position_fallback(
    rows: DataFrame, deployments: DataFrame, key: str = "deployment"
) -> DataFrame:
    """Row positions masked by their flags, else the deployment's static position.

    ``deployments(key, has_position, lat, lon)`` decides per deployment: a moving platform with a
    failing flag gets NULL, not the static position.
    """
    dim = deployments.select(
        key, "has_position", F.col("lat").alias("_slat"), F.col("lon").alias("_slon")
    )
    out = rows.join(dim, key, "left")
    flags = [c for c in ("lon_qc", "lat_qc") if c in rows.columns]
    for c, static in (("lat", "_slat"), ("lon", "_slon")):
        masked = clean.mask_range(c, *flags)
        out = out.withColumn(
            f"_{c}", F.when(F.col("has_position"), masked).otherwise(F.col(static))
        )
    return out.drop("lat", "lon", "_slat", "_slon", "has_position").withColumnsRenamed(
        {"_lat": "lat", "_lon": "lon"}
    )


def restrict(members: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Members whose key is wanted, letter case ignored."""
    k = wanted.select(F.upper(F.col(key).cast("string")).alias("_k")).distinct()
    return members.join(k, F.upper(members[key].cast("string")) == k["_k"], "left_semi")


def unmatched(wanted: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Wanted keys no member answers to."""
    k = members.select(F.upper(F.col(key).cast("string")).alias("_k")).distinct()
    return wanted.join(k, F.upper(wanted[key].cast("string")) == k["_k"], "left_anti")


def instruments_of_variables(variables: DataFrame, deployments: DataFrame) -> DataFrame:
    """Deployments per profile variable as one JSON list, ordered by position and start.

    Joined on (base, r, h, v) with the letter case of the base ignored. The list holds the
    instruments mounted at one site for one variable, a metadata-sized group.
    """
    v = variables.select("site_id", "variable", F.upper("base").alias("_b"), "r", "h", "v")
    d = deployments.withColumn("_b", F.upper("base")).drop("base", "column")
    item = F.struct("r", "h", "v", "instrument", "lat", "lon", "alt", "start", "stop")
    joined = v.join(d, ["site_id", "_b", "r", "h", "v"])
    return joined.groupBy("site_id", "variable").agg(
        F.to_json(F.array_sort(F.collect_list(item))).alias("instrument_deployments")
    )


def active_instrument(
    obs: DataFrame, deployments: DataFrame, keys: list[str], ts: str, bucket_days: int = 30
) -> DataFrame:
    """Observations with the instrument mounted at their time (start <= t < stop or still open).

    Closed deployments are laid out over the time buckets they touch and joined on (keys, bucket), so
    an observation meets only the instruments of its own bucket, not every one its position ever had.
    Open ones have no last bucket; they lie in one of their own that every observation also looks
    into. One scan and one equi join serve both. The join is never broadcast: laid out, a deployment is
    as many rows as it has buckets, which the planner's estimate does not know.
    """
    width, still_open = bucket_days * 86_400_000_000, -(1 << 62)

    def bucket(t):
        return F.floor(clean.micros(t) / F.lit(width))

    looked_up = F.array(bucket(ts), F.lit(still_open))
    rows = obs.withColumn("_b", F.explode(looked_up))
    d = deployments.filter("stop IS NULL OR start < stop").select(
        *keys, "instrument", "start", "stop",
        F.explode(
            F.when(F.col("stop").isNull(), F.array(F.lit(still_open)))
            .otherwise(F.sequence(bucket("start"), bucket("stop")))
        ).alias("_b"),
    )
    hit = (F.col(ts) >= F.col("start")) & (F.col("stop").isNull() | (F.col(ts) < F.col("stop")))
    return rows.join(d.hint("merge"), [*keys, "_b"]).filter(hit).drop("start", "stop", "_b")


def first_source(candidates: DataFrame, wanted: DataFrame, key: str, priority: str, columns):
    """First hit per wanted station over groups searched in ``priority`` order."""
    found = candidates.join(wanted.select(key).distinct(), key, "left_semi")
    return first_row_wins(found, [key], [priority], list(columns))


def climatology_fill(df, station: str, ts: str, value: str, name: str) -> DataFrame:
    """Missing cells take the mean of the same day of year of their series."""
    day = F.dayofyear(ts)
    means = (
        df.withColumn("_doy", day).groupBy(station, "_doy").agg(F.avg(value).alias("_mean"))
    )
    return (
        df.withColumn("_doy", day)
        .join(means, [station, "_doy"], "left")
        .withColumn(name, F.coalesce(F.col(value), F.col("_mean")))
        .drop("_doy", "_mean")
    )


def grid_mismatches(transforms: DataFrame, first: str, tolerance: float = 1e-9) -> DataFrame:
    """Files whose grid differs from the file that comes first in ``first`` order.

    ``numpy.allclose`` also allows a relative part of 1e-5 of the expected value.
    """
    cols = ["x0", "dx", "y0", "dy", "width", "height"]
    ref = transforms.agg(
        *[F.min_by(c, first).alias(f"_{c}") for c in cols]
    )
    far = F.lit(False)
    for c in cols:
        far = far | (F.abs(F.col(c) - F.col(f"_{c}")) > tolerance + 1e-5 * F.abs(F.col(f"_{c}")))
    # The reference grid is one row; it rides along as a constant key.
    left = transforms.withColumn("_one", F.lit(1))
    return left.join(F.broadcast(ref.withColumn("_one", F.lit(1))), "_one").filter(far).select(
        *transforms.columns
    )


def regular_grid(
    series: DataFrame, station: str, first: str | Column, last: str | Column, step: str, ts: str,
    *more: str,
):
    """Every slot from ``first`` to ``last`` for each row of ``series``, generated in place.

    Both may be columns, so that a row has slots of its own; ``more`` names columns to keep."""
    ends = [c if isinstance(c, Column) else F.lit(c) for c in (first, last)]
    slots = F.sequence(*[c.cast("timestamp_ntz") for c in ends], F.expr(step))
    return series.select(station, *more, F.explode(slots).alias(ts))


def reindex(grid: DataFrame, obs: DataFrame, keys: list[str]) -> DataFrame:
    """Grid slots with the observation that falls on them, else NULL."""
    return grid.join(obs, keys, "left")


def product_metadata(df: DataFrame, dim_product: DataFrame, name: str) -> DataFrame:
    """Descriptive columns of the product whose token the name contains (best priority first)."""
    token = F.coalesce(
        *[F.when(F.contains(F.upper(F.col(name)), F.lit(t)), F.lit(t))
          for t, _ in S.PRODUCT_PRIORITY]
    )
    return df.withColumn("product_token", token).join(dim_product, "product_token", "left")
