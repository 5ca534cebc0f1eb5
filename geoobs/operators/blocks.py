"""Ordered operators on raw rows of long series.

A series may hold a third of all rows, so no window here runs over a whole raw series. Rows are cut
into fixed time blocks; windows run inside (series, block), and only one summary row per block is
ordered along the series. The block is a pure function of the timestamp, so a recomputed task always
finds the same blocks. Rows without a time form one block after all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import micros
from .keys import join_null_safe

BLOCK_SECONDS = 3600


def with_block(df: DataFrame, ts: str, seconds: int = BLOCK_SECONDS) -> DataFrame:
    return df.withColumn("_block", F.floor(micros(ts) / F.lit(seconds * 1_000_000)))


def with_position(
    df: DataFrame, keys: list[str], ts: str, tie: list[str], name: str = "pos",
    total: str | None = None, seconds: int = BLOCK_SECONDS, within: Column | None = None,
) -> DataFrame:
    """Zero-based position of each row in its series ordered by ``ts`` and ``tie``.

    ``within`` is a condition on a block's ``_before`` and ``_n``, the rows ahead of it and in it (and
    ``total``); only rows of blocks that meet it are numbered and returned.
    """
    blocked = with_block(df, ts, seconds)
    inside = Window.partitionBy(*keys, "_block").orderBy(ts, *tie)
    series = Window.partitionBy(*keys)
    before = series.orderBy(F.col("_block").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = blocked.groupBy(*keys, "_block").agg(F.count("*").alias("_n")).select(
        *keys, "_block", "_n",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        *([F.sum("_n").over(series).alias(total)] if total else []),
    )
    if within is not None:
        offsets = offsets.filter(within)
    out = join_null_safe(blocked, offsets, [*keys, "_block"]).withColumn(
        "_in", F.row_number().over(inside) - 1
    )
    return out.withColumn(name, (F.col("_in") + F.col("_before")).cast("bigint")).drop(
        "_in", "_n", "_before", "_block"
    )


def with_previous(
    df: DataFrame, keys: list[str], ts: str, tie: list[str], columns: dict[str, str],
    seconds: int = BLOCK_SECONDS,
) -> DataFrame:
    """Columns of the preceding row of the series: ``columns`` maps source to new name."""
    return _with_neighbour(df, keys, ts, tie, columns, seconds, forward=False)


def with_next(
    df: DataFrame, keys: list[str], ts: str, tie: list[str], columns: dict[str, str],
    seconds: int = BLOCK_SECONDS,
) -> DataFrame:
    """Columns of the following row of the series."""
    return _with_neighbour(df, keys, ts, tie, columns, seconds, forward=True)


def _with_neighbour(df, keys, ts, tie, columns, seconds, forward):
    blocked = with_block(df, ts, seconds)
    inside = Window.partitionBy(*keys, "_block").orderBy(ts, *tie)
    step = F.lead if forward else F.lag
    pick = F.min_by if forward else F.max_by
    row = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(columns)])
    edge = blocked.groupBy(*keys, "_block").agg(
        pick(row, F.struct(F.col(ts), *[F.col(t) for t in tie])).alias("_edge")
    )
    along = Window.partitionBy(*keys).orderBy(F.col("_block").asc_nulls_last())
    edge = edge.select(*keys, "_block", step("_edge").over(along).alias("_across"))
    inner = blocked.withColumn("_row", row).withColumn("_inside", step("_row").over(inside))
    out = join_null_safe(inner, edge, [*keys, "_block"]).withColumn(
        "_near", F.coalesce("_inside", "_across")
    )
    for i, new in enumerate(columns.values()):
        out = out.withColumn(new, F.col(f"_near.f{i}"))
    return out.drop("_row", "_inside", "_across", "_near", "_block")


def time_index(df: DataFrame, ts: str, name: str = "time_index", seconds: int = BLOCK_SECONDS):
    """Distinct timestamps of all series with their position on the union time axis."""
    axis = df.select(ts).distinct()
    blocked = with_block(axis, ts, seconds)
    inside = Window.partitionBy("_block").orderBy(ts)
    # One summary row per block is ordered globally: hours of the covered span, not data rows.
    along = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocked.groupBy("_block").agg(F.count("*").alias("_n")).select(
        "_block", F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_before")
    )
    return (
        blocked.withColumn("_in", F.row_number().over(inside) - 1)
        .join(offsets, "_block")
        .select(ts, (F.col("_in") + F.col("_before")).cast("bigint").alias(name))
    )


def rows_between(
    df: DataFrame, keys: list[str], ts: str, tie: list[str], start: int | None,
    stop: int | None, step: int = 1,
) -> DataFrame:
    """Positional slice ``start <= position < stop`` of each series, every ``step``-th row of it.

    Negative positions count from the end of a series; None is its end.
    """
    if step < 1:
        raise ValueError("a step goes forward")
    start = start or 0
    from_end = start < 0 or (stop is not None and stop < 0)

    def place(i: int):
        return F.lit(i) if i >= 0 else F.greatest(F.col("_total") + i, F.lit(0))

    low = place(start)
    met = F.col("_before") + F.col("_n") > low
    if stop is not None:
        met = met & (F.col("_before") < place(stop))
    out = with_position(
        df, keys, ts, tie, "_pos", total="_total" if from_end else None, within=met
    )
    inside = (F.col("_pos") >= low) & ((F.col("_pos") - low) % step == 0)
    if stop is not None:
        inside = inside & (F.col("_pos") < place(stop))
    return out.filter(inside).drop("_pos", "_total")


def stride_sample(
    df: DataFrame, keys: list[str], ts: str, tie: list[str], max_points: int = 6000,
    seconds: int = BLOCK_SECONDS,
) -> DataFrame:
    """Every ceil(n / max_points)-th row of each series, starting with the first."""
    out = with_position(df, keys, ts, tie, "_pos", total="_total", seconds=seconds)
    step = F.ceil(F.col("_total") / F.lit(max_points))
    return out.filter(F.col("_pos") % step == 0).drop("_pos", "_total")


def gap_flags(
    df: DataFrame, keys: list[str], ts: str, tie: list[str], factor: float = 4.0,
    floor_seconds: float = 60.0,
) -> DataFrame:
    """``line_break`` where the step from the previous row exceeds max(factor x median, floor)."""
    from .percentiles import exact_percentiles

    steps = with_previous(df, keys, ts, tie, {ts: "_prev"}).withColumn(
        "step_s", F.floor(micros(ts) / 1_000_000) - F.floor(micros("_prev") / 1_000_000)
    ).drop("_prev")
    median = exact_percentiles(
        steps.filter(F.col("step_s").isNotNull()).select(*keys, F.col("step_s").cast("double")),
        keys, "step_s", {"median_step": 0.5},
    )
    limit = F.greatest(F.col("median_step") * factor, F.lit(floor_seconds))
    return (
        join_null_safe(steps, median, keys, "left")
        .withColumn("line_break", F.coalesce(F.col("step_s") > limit, F.lit(False)))
        .drop("median_step")
    )
