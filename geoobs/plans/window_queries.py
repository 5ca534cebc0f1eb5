"""Gridded series, ordered raw rows and spectra (F, I)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from .. import schema as S
from ..functions import clean
from ..operators import aggregates, blocks, spectral, windows
from . import adapters as A
from .registry import query


@query("rolling_trend", f"""WITH {A.DAILY_SQL}, r AS (
  SELECT variable, day, avg(value) OVER (PARTITION BY variable ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS m,
    row_number() OVER (PARTITION BY variable ORDER BY day) - 1 AS i FROM daily)
SELECT variable, day, round(CASE WHEN i >= 3 AND i < {A.DAYS_SQL} - 3 THEN m END, 6) AS trend FROM r""")
def rolling_trend(t):
    # The sample spans a month, so the window is seven days instead of 365; rolling_year has the latter.
    first, _, days = A.span(t)
    out = windows.rolling_trend(A.daily(t), "variable", "day", "value", first, days, half=3)
    return out.select("variable", "day", F.round("trend", 6).alias("trend"))


@query("rolling_day", f"""WITH {A.HOURLY_SQL}
SELECT variable, hour, round(CASE WHEN count(value) OVER w >= 6 THEN avg(value) OVER w END, 6) AS smooth FROM hourly
WINDOW w AS (PARTITION BY variable ORDER BY hour ROWS BETWEEN 12 PRECEDING AND 11 FOLLOWING)""")
def rolling_day(t):
    out = windows.rolling_day(A.hourly(t), "variable", "hour", "value")
    return out.select("variable", "hour", F.round("smooth", 6).alias("smooth"))


@query("best_window", f"""WITH {A.HOURLY_SQL}, d AS (
  SELECT variable, date_trunc('day', hour)::TIMESTAMP AS day, count(value) AS h FROM hourly GROUP BY ALL),
 s AS (SELECT variable, day, CAST(sum(h) OVER (PARTITION BY variable ORDER BY day ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS BIGINT) AS n_valid,
   row_number() OVER (PARTITION BY variable ORDER BY day) AS rn FROM d)
SELECT variable, arg_min(day, (tier, -n_valid, day)) AS start_day, arg_min(n_valid, (tier, -n_valid, day)) AS n_valid FROM (
  SELECT *, CASE WHEN n_valid >= 24 THEN CASE WHEN month(day + INTERVAL 60 HOUR) IN (6, 7, 8) THEN 0 ELSE 1 END ELSE 2 END AS tier FROM s WHERE rn + 4 <= {A.DAYS_SQL})
GROUP BY variable""")
def best_window(t):
    first, _, days = A.span(t)
    return windows.best_window(
        A.hourly(t), "variable", "hour", F.col("value").isNotNull(), first, days, 5,
        min_share=0.2,
    )


_INTERPOLATED = f"""{A.HOURLY_SQL}, near AS (
  SELECT variable, hour, value, date_diff('hour', {A.FIRST_SQL}, hour) AS i,
    last_value(value IGNORE NULLS) OVER b AS pv, last_value(CASE WHEN value IS NOT NULL THEN date_diff('hour', {A.FIRST_SQL}, hour) END IGNORE NULLS) OVER b AS pi,
    first_value(value IGNORE NULLS) OVER a AS nv, first_value(CASE WHEN value IS NOT NULL THEN date_diff('hour', {A.FIRST_SQL}, hour) END IGNORE NULLS) OVER a AS ni
  FROM hourly WINDOW b AS (PARTITION BY variable ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    a AS (PARTITION BY variable ORDER BY hour ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
 s1 AS (SELECT *, coalesce(value, CASE WHEN pi IS NOT NULL AND ni IS NOT NULL AND {{reach}} <= 2 THEN pv + (nv - pv) * (i - pi) / (ni - pi) END) AS v1 FROM near)"""


@query("interpolate_prefix", "WITH " + _INTERPOLATED.format(reach="i - pi") + """
SELECT variable, hour, round(v1, 6) AS value FROM s1""")
def interpolate_prefix(t):
    out = windows.interpolate(A.hourly(t), "variable", "hour", "value", A.span(t)[0], limit=2)
    return out.select("variable", "hour", F.round("value", 6).alias("value"))


@query("interpolate_whole_gap", "WITH " + _INTERPOLATED.format(reach="ni - pi - 1") + """
SELECT variable, hour, round(v1, 6) AS value FROM s1""")
def interpolate_whole_gap(t):
    out = windows.interpolate(
        A.hourly(t), "variable", "hour", "value", A.span(t)[0], limit=2, mode="whole_gap"
    )
    return out.select("variable", "hour", F.round("value", 6).alias("value"))


@query("fill_both_ways", f"""WITH {A.HOURLY_SQL}
SELECT variable, hour, coalesce(last_value(value IGNORE NULLS) OVER (PARTITION BY variable ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(value IGNORE NULLS) OVER (PARTITION BY variable ORDER BY hour ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value FROM hourly""")
def fill_both_ways(t):
    return windows.fill_both_ways(A.hourly(t), "variable", "hour", "value").select(
        "variable", "hour", "value"
    )


_FILLED = _INTERPOLATED.format(reach="i - pi") + """, s2 AS (
  SELECT variable, hour, i, coalesce(v1, avg(v1) OVER (PARTITION BY variable, dayofyear(hour))) AS v2 FROM s1),
 filled AS (SELECT variable, hour, i, coalesce(last_value(v2 IGNORE NULLS) OVER (PARTITION BY variable ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(v2 IGNORE NULLS) OVER (PARTITION BY variable ORDER BY hour ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS x FROM s2)"""
_N = f"({A.DAYS_SQL} * 24)"


def _filled(t):
    first = A.span(t)[0]
    out = windows.fill_gaps(A.hourly(t), "variable", "hour", "value", first, "x", limit=2)
    return windows.assert_filled(out, "x").withColumn("i", windows.slot_number("hour", first, 3600))


def _slots(t) -> int:
    return A.span(t)[2] * 24


@query("gap_filled_series", f"""WITH {_FILLED} SELECT variable, hour, round(x, 9) AS x FROM filled""")
def gap_filled_series(t):
    return _filled(t).select("variable", "hour", F.round("x", 9).alias("x"))


_DETRENDED = f"""{_FILLED}, fit AS (SELECT variable, regr_slope(x, i) AS a, regr_intercept(x, i) AS b FROM filled GROUP BY variable),
 w AS (SELECT variable, hour, i, 0.5 - 0.5 * cos(2 * pi() * i / ({_N} - 1)) AS hann,
   (x - (a * i + b)) * (0.5 - 0.5 * cos(2 * pi() * i / ({_N} - 1))) AS x FROM filled JOIN fit USING (variable))"""


@query("detrend_hann", f"""WITH {_DETRENDED} SELECT variable, hour, round(hann, 9) AS hann, round(x, 6) AS x FROM w""")
def detrend_hann(t):
    out = windows.detrend_hann(_filled(t), "variable", "i", "x", _slots(t))
    return out.select("variable", "hour", F.round("hann", 9).alias("hann"),
                      F.round("x", 6).alias("x"))


_POWER = " UNION ALL ".join(
    f"SELECT variable, '{name}' AS frequency, 2 / 24.0 * (sum(x * cos(i * {2 * math.pi * f / 24!r})) ** 2 "
    f"+ sum(x * sin(i * {2 * math.pi * f / 24!r})) ** 2) / sum(hann * hann) AS power FROM w GROUP BY variable"
    for name, f in S.KEY_FREQUENCIES
)


@query("key_frequency_power", f"""WITH {_DETRENDED} SELECT variable, frequency, round(power, 4) AS power FROM ({_POWER})""")
def key_frequency_power(t):
    out = spectral.power_at(_filled(t), "variable", "i", "x", _slots(t))
    return out.select("variable", "frequency", F.round("power", 4).alias("power"))


_SPECTRUM = f"""{_DETRENDED}, spectrum AS (
 SELECT variable, k * 24.0::DOUBLE / {_N} AS f_per_day,
   2 / 24.0::DOUBLE * (sum(x * cos(2 * pi() * k * i / {_N})) ** 2 + sum(x * sin(2 * pi() * k * i / {_N})) ** 2) / sum(hann * hann) AS power
 FROM w, (SELECT unnest(generate_series(1, {_N} // 2)) AS k) GROUP BY variable, k)"""


@query("power_spectrum", f"""WITH {_SPECTRUM}
SELECT variable, round(f_per_day, 9) AS f_per_day, round(power, 3) AS power FROM spectrum""")
def power_spectrum(t):
    return spectral.power_spectrum(_filled(t), "variable", "i", "x").select(
        "variable", F.round("f_per_day", 9).alias("f_per_day"), F.round("power", 3).alias("power")
    )


@query("binned_spectrum", f"""WITH {_SPECTRUM},
 b AS (SELECT variable, log10(min(f_per_day)) AS lo, log10(max(f_per_day)) AS hi FROM spectrum GROUP BY 1)
SELECT variable, least(CAST(floor((log10(f_per_day) - lo) / (hi - lo) * 349) AS INTEGER) + 1, 349) AS bin, count(*) AS n_freqs, round(avg(power), 3) AS mean_power
FROM spectrum JOIN b USING (variable) GROUP BY ALL""")
def binned_spectrum(t):
    spectrum = spectral.power_spectrum(_filled(t), "variable", "i", "x")
    return aggregates.log_bins(spectrum, ["variable"], "f_per_day", "power").select(
        "variable", "bin", "n_freqs", F.round("mean_power", 3).alias("mean_power")
    )


# The greatest prime number of hours in the span.
_PRIME = f"""(SELECT max(p) FROM (SELECT unnest(range(2, {_N} + 1)) AS p)
   WHERE NOT EXISTS (SELECT 1 FROM (SELECT unnest(range(2, 3000)) AS d) WHERE d * d <= p AND p % d = 0))"""


def _prime(n: int) -> int:
    while any(n % d == 0 for d in range(2, math.isqrt(n) + 1)):
        n -= 1
    return n


@query("prime_spectrum", f"""WITH {_FILLED}, pr AS (SELECT {_PRIME} AS p),
 s AS (SELECT variable, i, x, p FROM filled, pr WHERE i < p),
 fit AS (SELECT variable, regr_slope(x, i) AS a, regr_intercept(x, i) AS b FROM s GROUP BY variable),
 w AS (SELECT variable, i, p, 0.5 - 0.5 * cos(2 * pi() * i / (p - 1)) AS hann, (x - (a * i + b)) * (0.5 - 0.5 * cos(2 * pi() * i / (p - 1))) AS x FROM s JOIN fit USING (variable)),
 f AS (SELECT variable, p, k, 2 / 24.0::DOUBLE * (sum(x * cos(2 * pi() * ((k * i) % p) / p)) ** 2 + sum(x * sin(2 * pi() * ((k * i) % p) / p)) ** 2) / sum(hann * hann) AS power
   FROM w, (SELECT unnest(generate_series(1, (SELECT p FROM pr) // 2)) AS k) GROUP BY variable, p, k)
SELECT variable, round(k * 24.0::DOUBLE / p, 9) AS f_per_day, round(power, 3) AS power FROM f""")
def prime_spectrum(t):
    """A series whose length is a prime number, dealt over tasks in three steps."""
    rows = _filled(t).filter(F.col("i") < _prime(_slots(t)))
    return spectral.power_spectrum(rows, "variable", "i", "x", whole=0).select(
        "variable", F.round("f_per_day", 9).alias("f_per_day"), F.round("power", 3).alias("power")
    )


_BANDS = " ".join(
    f"WHEN f_per_day >= {low!r}::DOUBLE AND f_per_day < {high!r}::DOUBLE THEN '{name}'"
    for name, low, high in S.BANDS
)


@query("band_power", f"""WITH {_SPECTRUM}, d AS (SELECT variable, min(f_per_day) AS df FROM spectrum GROUP BY 1)
SELECT variable, band, count(*) AS n_freqs, round(sum(power * df), 3) AS band_power
FROM (SELECT *, CASE {_BANDS} END AS band FROM spectrum) JOIN d USING (variable) WHERE band IS NOT NULL GROUP BY ALL""")
def band_power(t):
    spectrum = spectral.power_spectrum(_filled(t), "variable", "i", "x")
    return spectral.band_power(spectrum, "variable").select(
        "variable", "band", "n_freqs", F.round("band_power", 3).alias("band_power")
    )


@query("log_bins", """
WITH p AS (SELECT l_returnflag, l_extendedprice AS f, l_quantity AS p FROM lineitem WHERE l_extendedprice > 0),
 b AS (SELECT l_returnflag, log10(min(f)) AS lo, log10(max(f)) AS hi FROM p GROUP BY 1)
SELECT l_returnflag, least(CAST(floor((log10(f) - lo) / (hi - lo) * 349) AS INTEGER) + 1, 349) AS bin, count(*) AS n_freqs, round(avg(p), 6) AS mean_power
FROM p JOIN b USING (l_returnflag) GROUP BY ALL""")
def log_bins(t):
    out = aggregates.log_bins(t.lineitem, ["l_returnflag"], "l_extendedprice", "l_quantity")
    return out.select("l_returnflag", "bin", "n_freqs", F.round("mean_power", 6).alias("mean_power"))


@query("line_breaks", f"""WITH {A.TRACK_SQL}, s AS (
  SELECT deployment, seq, epoch(date_trunc('second', time))::BIGINT - lag(epoch(date_trunc('second', time))::BIGINT) OVER (PARTITION BY deployment ORDER BY time, seq) AS step_s FROM track),
 m AS (SELECT deployment, median(step_s) AS med FROM s GROUP BY deployment)
SELECT deployment, seq, step_s, coalesce(step_s > greatest(4 * med, 60), false) AS line_break FROM s JOIN m USING (deployment)""")
def line_breaks(t):
    out = blocks.gap_flags(A.track(t), ["deployment"], "time", ["seq"])
    return out.select("deployment", "seq", "step_s", "line_break")


@query("stride_sample", f"""WITH {A.TRACK_SQL}
SELECT deployment, seq FROM (SELECT deployment, seq, row_number() OVER (PARTITION BY deployment ORDER BY time, seq) - 1 AS i,
  count(*) OVER (PARTITION BY deployment) AS n FROM track) WHERE i % CAST(ceil(n / 20.0) AS BIGINT) = 0""")
def stride_sample(t):
    # The sampling operator itself: at most 20 points per track.
    return blocks.stride_sample(A.track(t), ["deployment"], "time", ["seq"], 20).select(
        "deployment", "seq"
    )


@query("time_index", f"""WITH {A.OBS_SQL}
SELECT hour, row_number() OVER (ORDER BY hour) - 1 AS time_index FROM (SELECT DISTINCT date_trunc('hour', time)::TIMESTAMP AS hour FROM obs)""")
def time_index(t):
    o = A.obs(t).select(clean.hour_floor("time").alias("hour"))
    return blocks.time_index(o, "hour", seconds=86_400)


@query("previous_observation", f"""WITH {A.OBS_SQL}
SELECT seq, lag(value) OVER w AS before, lead(value) OVER w AS after FROM obs WINDOW w AS (PARTITION BY station_id ORDER BY time, seq)""")
def previous_observation(t):
    o = blocks.with_previous(A.obs(t), ["station_id"], "time", ["seq"], {"value": "before"})
    o = blocks.with_next(o, ["station_id"], "time", ["seq"], {"value": "after"})
    return o.select("seq", "before", "after")
