"""Exact percentiles (linear interpolation) of groups of any size.

The built-in exact percentile keeps every distinct value of a group in one task. Here a sketch of the
raw rows, made map-side, cuts each group into ranges; a histogram over them, counted map-side too,
finds those that hold the wanted ranks, and only rows of these are shuffled and ordered. The ranges
need not be even: the exact count below each is carried along, so the result does not depend on how
the group was cut.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .keys import join_null_safe


def exact_percentiles(
    df: DataFrame, keys: list[str], value: str, points: dict[str, float], bins: int = 64,
    parts: int = 64,
) -> DataFrame:
    """One row per group with a column per entry of ``points`` (name -> fraction).

    Each group is cut at ``bins`` quantiles (a power of two) and each piece into ``parts`` even
    ones, so what is finally ordered is about one in bins x parts of its distinct values; where values
    crowd at one place of a piece, up to one in ``bins``.
    """
    if not keys:
        return exact_percentiles(df.withColumn("_all", F.lit(0)), ["_all"], value, points, bins, parts).drop(
            "_all"
        )
    cells = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    # Quantile cuts of the rows; any cuts give the exact result.
    fractions = F.array(*[F.lit(i / bins) for i in range(bins + 1)])
    cuts = cells.groupBy(*keys).agg(
        F.array_distinct(F.percentile_approx("_v", fractions, F.lit(4 * bins))).alias("_cuts"),
        F.count("*").alias("_total"),
    )
    # Piece i holds cuts[i-1] <= v < cuts[i]; found by halving, a step past the end counts as larger.
    binned = join_null_safe(cells, cuts, keys).withColumn("_bin", F.lit(0))
    step = bins
    while step:
        beyond = F.get("_cuts", F.col("_bin") + (step - 1)) <= F.col("_v")
        binned = binned.withColumn(
            "_bin", F.col("_bin") + F.when(beyond, F.lit(step)).otherwise(F.lit(0))
        )
        step //= 2
    low, high = F.get("_cuts", F.col("_bin") - 1), F.get("_cuts", F.col("_bin"))
    even = F.floor((F.col("_v") - low) / (high - low) * parts)
    # Only a finite, non-empty piece is split; every other keeps its values together.
    part = F.when((high > low) & (high - low < 1e300), F.least(even, F.lit(parts - 1)))
    binned = binned.withColumn("_bin", F.col("_bin") * parts + F.coalesce(part, F.lit(0)))
    hist = binned.groupBy(*keys, "_bin").agg(
        F.count("*").alias("_n"),
        F.min("_v").alias("_lo"),
        F.max("_v").alias("_hi"),
        F.first("_total").alias("_total"),
    )
    along = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.withColumn("_below", F.coalesce(F.sum("_n").over(along), F.lit(0)))

    def ranks(q: float):
        exact = F.lit(float(q)) * (F.col("_total") - 1)
        return F.floor(exact), F.ceil(exact)

    wanted = [r for q in points.values() for r in ranks(q)]
    hit = reduce(
        lambda a, b: a | b,
        [(r >= F.col("_below")) & (r < F.col("_below") + F.col("_n")) for r in wanted],
    )
    ranges = hist.filter(hit).select(*keys, "_lo", "_hi", "_below", "_total")
    # Rows of the hit ranges, equal values added up before the shuffle.
    narrowed = join_null_safe(cells, ranges, keys).filter(
        F.col("_v").between(F.col("_lo"), F.col("_hi"))
    ).groupBy(*keys, "_lo", "_below", "_total", "_v").agg(F.count("*").alias("_c"))
    inside = Window.partitionBy(*keys, "_lo").orderBy("_v")
    ordered = narrowed.withColumn(
        "_end", F.col("_below") + F.sum("_c").over(inside.rowsBetween(
            Window.unboundedPreceding, Window.currentRow))
    ).withColumn("_start", F.col("_end") - F.col("_c"))

    def at(rank):
        return F.max(F.when((rank >= F.col("_start")) & (rank < F.col("_end")), F.col("_v")))

    out = []
    for name, q in points.items():
        below, above = ranks(q)
        weight = F.max(F.lit(float(q)) * (F.col("_total") - 1) - below)
        out.append((at(below) + (at(above) - at(below)) * weight).alias(name))
    return ordered.groupBy(*keys).agg(*out)


def colour_bounds(df: DataFrame, keys: list[str], value: str, low=0.02, high=0.98) -> DataFrame:
    """``vmin``/``vmax`` percentiles; a degenerate range falls back to the extremes, then to +1."""
    p = exact_percentiles(df, keys, value, {"_p_lo": low, "_p_hi": high})
    ext = df.groupBy(*keys).agg(F.min(value).alias("_min"), F.max(value).alias("_max"))
    both = join_null_safe(p, ext, keys)
    flat = F.col("_p_hi") <= F.col("_p_lo")
    top = F.when(F.col("_max") > F.col("_min"), F.col("_max")).otherwise(F.col("_min") + 1.0)
    return both.select(
        *keys,
        F.when(flat, F.col("_min")).otherwise(F.col("_p_lo")).alias("vmin"),
        F.when(flat, top).otherwise(F.col("_p_hi")).alias("vmax"),
    )
