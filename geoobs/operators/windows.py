"""Window operators on gridded series.

A gridded series has one row per slot, which is still long on a grid of minutes over years. So no
window here runs over a whole series: rows are cut into segments of ``SEGMENT`` slots, windows run
inside (series, segment), and what reaches across comes either from a few slots that neighbouring
segments share or from one summary row for each segment. The segment is a pure function of the
timestamp. Raw rows go through ``blocks`` instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import micros, slot_start
from . import blocks
from .keys import join_null_safe


# Slots of a segment.
SEGMENT = 4096


def slot_number(ts: str, first: str, seconds: int) -> Column:
    """Zero-based slot of a timestamp on a grid that starts at ``first``; no window needed."""
    start = micros(F.lit(first).cast("timestamp_ntz"))
    return F.floor((micros(ts) - start) / F.lit(seconds * 1_000_000)).cast("bigint")


def _rolling(
    grid: DataFrame, station: str, ts: str, seconds: int, before: int, after: int,
    columns: dict, segment: int = SEGMENT,
) -> DataFrame:
    """Aggregates over the slots from ``before`` ahead of a row to ``after`` behind it.

    Every row also goes to the neighbouring segments whose frames reach it, and counts there without
    being returned, so all frames lie inside one segment.
    """
    width = max(segment, 4 * (before + after))
    slot = F.floor(micros(ts) / F.lit(seconds * 1_000_000))
    spread = grid.withColumn("_slot", slot).withColumn("_segment", F.explode(F.sequence(
        F.floor((F.col("_slot") - after) / width), F.floor((F.col("_slot") + before) / width)
    )))
    w = Window.partitionBy(station, "_segment").orderBy("_slot").rangeBetween(-before, after)
    out = spread.withColumns({name: make(w) for name, make in columns.items()})
    own = F.floor(F.col("_slot") / width) == F.col("_segment")
    return out.filter(own).drop("_slot", "_segment")


def rolling_trend(
    daily: DataFrame, station: str, day: str, value: str, first: str, n_days: int,
    name: str = "trend", half: int = 182, segment: int = SEGMENT,
) -> DataFrame:
    """Centred running mean of 2 x half + 1 days (any filled day suffices), ends set to NULL."""
    out = _rolling(
        daily, station, day, 86_400, half, half, {name: lambda w: F.avg(value).over(w)}, segment
    )
    i = slot_number(day, first, 86_400)
    inside = (i >= half) & (i < n_days - half)
    return out.withColumn(name, F.when(inside, F.col(name)))


def rolling_trend_of(
    obs: DataFrame, series: DataFrame, station: str, day: str, value: str, first: str, n_days: int,
    name: str = "trend", half: int = 182, segment: int = SEGMENT,
) -> DataFrame:
    """``rolling_trend`` of the grid of all days of each of ``series``, made from the observed days alone:
    ``obs`` has a row for each of them, other days are empty. A series that is null has only empty days.

    Only observations are shuffled, to the segments whose frames they reach; a task lays out one segment
    at a time. Frames span at most two blocks of their own width, so a mean is the sum of a block's end and
    of the next one's beginning: no work for each slot of a frame, and nothing is ever subtracted.
    """
    frame = 2 * half + 1
    width = max(segment, 8 * half)
    n_segments = -(-n_days // width)
    slot = slot_number(day, first, 86_400)
    reached = F.sequence(F.floor((slot - half) / width), F.floor((slot + half) / width))
    seen = obs.filter(F.col(station).isNotNull() & F.col(value).isNotNull()).select(
        station, F.explode(reached).alias("_segment"),
        F.struct(slot.alias("i"), F.col(value).cast("double").alias("v")).alias("_o"),
    ).filter(F.col("_segment").between(0, n_segments - 1))
    whole = series.select(station).distinct().select(
        station, F.explode(F.sequence(
            F.lit(0).cast("bigint"), F.lit(n_segments - 1).cast("bigint"))).alias("_segment"),
        F.lit(None).cast(seen.schema["_o"].dataType).alias("_o"))
    cells = seen.unionAll(whole).groupBy(station, "_segment").agg(F.collect_list("_o").alias("_o"))
    start = np.datetime64(first, "us")

    def sums(x: np.ndarray, m: int) -> np.ndarray:
        blocks_of = x.reshape(-1, frame)
        begun = blocks_of.cumsum(1).ravel()[frame - 1:frame - 1 + m]
        rest = blocks_of[:, ::-1].cumsum(1)[:, ::-1].ravel()[:m]
        rest[::frame] = 0
        return rest + begun

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stations, found = batch.column(0), batch.column(2)
            flat, bounds = found.flatten(), found.offsets.to_numpy() - found.offsets[0].as_py()
            at, values = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            held, rows = [], 0
            for k, part in enumerate(batch.column(1).to_pylist()):
                lo, m = part * width, min(width, n_days - part * width)
                total = np.zeros(-(-(m + frame - 1) // frame) * frame)
                filled = np.zeros_like(total)
                own = slice(bounds[k], bounds[k + 1])
                place = at[own] - lo + half
                near = place < len(total)
                total[place[near]], filled[place[near]] = values[own][near], 1
                counts, i = sums(filled, m), lo + np.arange(m)
                empty = (counts == 0) | (i < half) | (i >= n_days - half)
                mean = sums(total, m) / np.where(counts == 0, 1, counts)
                held.append((np.full(m, k), i, mean, empty))
                rows += m
                if rows >= 1 << 16 or k + 1 == len(batch):
                    owner, i, mean, empty = (np.concatenate(x) for x in zip(*held))
                    held, rows = [], 0
                    yield pa.RecordBatch.from_arrays(
                        [stations.take(pa.array(owner)),
                         pa.array(start + i * np.timedelta64(86_400_000_000, "us")),
                         pa.array(mean, mask=empty)], names=[station, day, name])

    kind = cells.schema[station].dataType.simpleString()
    return cells.mapInArrow(run, f"`{station}` {kind}, `{day}` timestamp_ntz, `{name}` double")


def rolling_day(
    hourly: DataFrame, station: str, ts: str, value: str, name: str = "smooth",
    width: int = 24, min_count: int = 6, seconds: int = 3600, segment: int = SEGMENT,
) -> DataFrame:
    """Centred running mean of an even window: width/2 slots before to width/2 - 1 after."""
    return _rolling(hourly, station, ts, seconds, width // 2, (width - 1) // 2, {
        name: lambda w: F.when(F.count(value).over(w) >= min_count, F.avg(value).over(w))
    }, segment)


def best_window(
    hourly: DataFrame, station: str, ts: str, valid: Column, first: str, grid_days: int,
    n_days: int, months=(6, 7, 8), min_share: float = 0.8,
) -> DataFrame:
    """Start day of the n-day window with the most valid hours.

    Windows centred in ``months`` with enough coverage come first, then any with enough coverage,
    then any; the earliest of equal windows wins.
    """
    daily = hourly.groupBy(station, slot_start(ts, "DAY").alias("day")).agg(
        F.count_if(valid).alias("_h")
    )
    w = Window.partitionBy(station).orderBy("day").rowsBetween(0, n_days - 1)
    hours = n_days * 24
    sums = daily.withColumn("n_valid", F.sum("_h").over(w)).filter(
        slot_number("day", first, 86_400) + n_days <= grid_days
    )
    mid = F.month(F.timestamp_add("HOUR", F.lit(hours // 2), F.col("day")))
    enough = F.col("n_valid") >= min_share * hours
    tier = F.when(enough & mid.isin(list(months)), 0).when(enough, 1).otherwise(2)
    rank = F.struct(tier.alias("a"), (-F.col("n_valid")).alias("b"), F.col("day").alias("c"))
    return sums.groupBy(station).agg(
        F.min_by(F.struct("day", "n_valid"), rank).alias("_b")
    ).select(station, F.col("_b.day").alias("start_day"), F.col("_b.n_valid").alias("n_valid"))


def _neighbours(
    df: DataFrame, station: str, ts: str, value: str, slot: Column, seconds: int, segment: int
) -> DataFrame:
    """Nearest filled value and slot on both sides of each row.

    Inside a segment by windows; a segment's last and first filled value are carried across in one row
    for each. The look-ahead runs over the descending order: a frame up to unbounded following would
    be recomputed for every row.
    """
    run = (Window.unboundedPreceding, Window.currentRow)
    keys = [station, "_block"]
    placed = blocks.with_block(df, ts, seconds * segment).withColumn("_i", slot)
    filled = F.when(
        F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), F.col("_i").alias("i"))
    )
    at = F.when(F.col(value).isNotNull(), F.col(ts))
    ends = placed.groupBy(*keys).agg(
        F.max_by(filled, at).alias("_last"), F.min_by(filled, at).alias("_first")
    )
    along, earlier = Window.partitionBy(station), (Window.unboundedPreceding, -1)
    ends = ends.select(
        *keys,
        F.last("_last", ignorenulls=True).over(
            along.orderBy(F.col("_block").asc()).rowsBetween(*earlier)).alias("_before"),
        F.last("_first", ignorenulls=True).over(
            along.orderBy(F.col("_block").desc()).rowsBetween(*earlier)).alias("_after"),
    )
    inside = Window.partitionBy(*keys)
    back = inside.orderBy(F.col(ts).asc()).rowsBetween(*run)
    ahead = inside.orderBy(F.col(ts).desc()).rowsBetween(*run)
    near = placed.withColumn("_p", F.last(filled, ignorenulls=True).over(back)).withColumn(
        "_n", F.last(filled, ignorenulls=True).over(ahead))
    return join_null_safe(near, ends, keys).withColumns({
        "_p": F.coalesce("_p", "_before"), "_n": F.coalesce("_n", "_after")
    }).drop("_block", "_before", "_after")


def interpolate(
    grid: DataFrame, station: str, ts: str, value: str, first: str, seconds: int = 3600,
    limit: int = 168, mode: str = "prefix", name: str | None = None, segment: int = SEGMENT,
) -> DataFrame:
    """Linear time interpolation of interior gaps.

    ``prefix`` fills the first ``limit`` slots of every interior gap, ``whole_gap`` only gaps that
    are no longer than ``limit``. The ends are never filled.
    """
    slot = slot_number(ts, first, seconds)
    near = _neighbours(grid, station, ts, value, slot, seconds, segment)
    span = F.col("_n.i") - F.col("_p.i")
    reach = (F.col("_i") - F.col("_p.i")) if mode == "prefix" else (span - 1)
    line = F.col("_p.v") + (F.col("_n.v") - F.col("_p.v")) * (F.col("_i") - F.col("_p.i")) / span
    fill = F.when(F.col("_p").isNotNull() & F.col("_n").isNotNull() & (reach <= limit), line)
    return near.withColumn(name or value, F.coalesce(F.col(value), fill)).drop("_i", "_p", "_n")


def interpolate_of(
    obs: DataFrame, series: DataFrame, station: str, ts: str, value: str, first: str, last: str,
    step: str, seconds: int = 3600, limit: int = 168, mode: str = "prefix", segment: int = SEGMENT,
) -> DataFrame:
    """``interpolate`` of the grid of all slots of each of ``series``, made from the observed slots alone:
    ``obs`` has a row for each of them, other slots are empty. A series that is null has only empty slots.

    Observations look up the next one of their series; the slots between are generated behind each of
    them, so nothing but observations is shuffled or ordered.
    """
    from .joins import regular_grid

    seen = obs.filter(F.col(station).isNotNull() & F.col(value).isNotNull()).select(
        station, F.col(ts).alias("_t"), F.col(value).alias("_v"))
    ends = [F.lit(t).cast("timestamp_ntz") for t in (first, last)]
    following = blocks.with_next(
        seen, [station], "_t", [], {"_t": "_nt", "_v": "_nv"}, seconds * segment)
    # Slots before the first observation hang on the series, as all do of one without any.
    began = seen.groupBy(station).agg(F.min("_t").alias("_nt"))
    head = series.select(station).distinct().join(began, station, "left").select(
        station, F.lit(None).cast("timestamp_ntz").alias("_t"),
        F.lit(None).cast(seen.schema["_v"].dataType).alias("_v"), "_nt",
        F.lit(None).cast(seen.schema["_v"].dataType).alias("_nv"))
    stretches = following.select(station, "_t", "_v", "_nt", "_nv").unionByName(
        head.filter(F.col("_nt").isNull() | (F.col("_nt") > ends[0])))
    before = F.timestamp_add("SECOND", F.lit(-seconds), F.col("_nt"))
    # Numbers of both ends are taken once for a stretch, not for each of its slots.
    stretches = stretches.withColumns({
        "_i": slot_number("_t", first, seconds),
        "_span": slot_number("_nt", first, seconds) - slot_number("_t", first, seconds)})
    slots = regular_grid(
        stretches, station, F.coalesce("_t", ends[0]), F.coalesce(before, ends[1]), step, ts,
        "_i", "_v", "_span", "_nv").withColumn("_k", slot_number(ts, first, seconds) - F.col("_i"))
    reach = F.col("_k") if mode == "prefix" else F.col("_span") - 1
    line = F.col("_v") + (F.col("_nv") - F.col("_v")) * F.col("_k") / F.col("_span")
    return slots.select(station, ts, F.when(F.col("_k") == 0, F.col("_v")).when(
        F.col("_span").isNotNull() & (reach <= limit), line).alias(value))


def fill_both_ways(
    grid: DataFrame, station: str, ts: str, value: str, name: str | None = None,
    seconds: int = 3600, segment: int = SEGMENT,
) -> DataFrame:
    """Last value carried forward, then the first value carried back."""
    near = _neighbours(grid, station, ts, value, F.lit(0), seconds, segment)
    return near.withColumn(
        name or value, F.coalesce(F.col(value), F.col("_p.v"), F.col("_n.v"))
    ).drop("_i", "_p", "_n")


def fill_gaps(
    grid: DataFrame, station: str, ts: str, value: str, first: str, name: str,
    seconds: int = 3600, limit: int = 168, mode: str = "prefix", segment: int = SEGMENT,
) -> DataFrame:
    """Interpolation, then the day-of-year mean of the interpolated series, then carry."""
    from .joins import climatology_fill

    step1 = interpolate(grid, station, ts, value, first, seconds, limit, mode, "_s1", segment)
    step2 = climatology_fill(step1, station, ts, "_s1", "_s2")
    filled = fill_both_ways(step2, station, ts, "_s2", name, seconds, segment)
    return filled.drop("_s1", "_s2")


def assert_filled(df: DataFrame, value: str) -> DataFrame:
    """The same rows; the job fails on a missing value."""
    message = F.lit(f"{value} still has missing values")
    return df.withColumn(
        value, F.when(F.col(value).isNull(), F.raise_error(message).cast("double")).otherwise(
            F.col(value))
    )


def detrend_hann(df: DataFrame, station: str, slot: str, value: str, n: int, name="x"):
    """Linear trend removed and Hann weight applied on a complete series of ``n`` slots.

    The fit is two aggregates per station, so no window is involved.
    """
    fit = df.groupBy(station).agg(
        F.regr_slope(value, slot).alias("_a"), F.regr_intercept(value, slot).alias("_b")
    )
    weight = 0.5 - 0.5 * F.cos(2 * F.pi() * F.col(slot) / F.lit(float(n - 1)))
    return (
        join_null_safe(df, fit, [station])
        .withColumn("hann", weight)
        .withColumn(name, (F.col(value) - (F.col("_a") * F.col(slot) + F.col("_b"))) * weight)
        .drop("_a", "_b")
    )


def compact_queries(
    log: DataFrame, session: str = "session", seq: str = "seq", ts: str | None = None
) -> DataFrame:
    """Query log without bare accesses that a selection on the same variable directly follows.

    ``seq`` orders the entries of a session; numbers may be missing. The following entry is found
    within blocks of numbers, so a long session is spread over all tasks.
    """
    following = {"op": "_op", "variable": "_v", "group": "_g"}
    placed = log.withColumn("_at", F.timestamp_seconds(F.col(seq)))
    nxt = blocks.with_next(placed, [session], "_at", [seq], following)
    bare = F.col("op") == "access"
    # A following access/where never replaces; only sel and isel on the same variable do.
    replaced = (
        bare & F.col("_op").isin("sel", "isel") & F.col("variable").eqNullSafe(F.col("_v"))
        & F.col("group").eqNullSafe(F.col("_g"))
    )
    return nxt.filter(~F.coalesce(replaced, F.lit(False))).drop("_at", "_op", "_v", "_g")


def last_surviving(log: DataFrame, session: str, seq: str, stations: str) -> DataFrame:
    """Per session the station list of its last entry that has one."""
    has = F.when(F.col(stations).isNotNull(), F.col(seq))
    return log.groupBy(session).agg(F.max_by(F.col(stations), has).alias(stations))


rows_between = blocks.rows_between
stride_sample = blocks.stride_sample
gap_flags = blocks.gap_flags
