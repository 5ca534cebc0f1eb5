"""Long series at the parameters they are meant for: seven years of days, and a dense request log.

Spans are read off the data, so no row lies outside of a grid.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean
from ..operators import aggregates, blocks, joins, sessions, windows
from . import adapters as A
from .registry import query

HALF, LIMIT, POINTS, IDLE = 182, 168, 6000, 300


def _day(c):
    return F.col(c).cast("date").cast("timestamp_ntz")


def _span(rows, day: str):
    """First and last day as text, and the number of days: one row of the data."""
    r = rows.agg(
        F.min(day).cast("string"), F.max(day).cast("string"), F.date_diff(F.max(day), F.min(day))
    ).first()
    return str(r[0]), str(r[1]), int(r[2]) + 1


def _daily(t, table: str, series: str, day: str, value: str):
    """A value per series and observed day, all series, and the first and last day and length of their
    grid."""
    rows = t.__getattr__(table).select(
        F.col(series).alias("series"), _day(day).alias("day"), F.col(value).alias("value")
    )
    means = rows.filter("day IS NOT NULL").groupBy("series", "day").agg(F.avg("value").alias("value"))
    return means, rows.select("series").distinct(), *_span(rows, "day")


def _daily_sql(table: str, series: str, day: str, value: str) -> str:
    return f"""rows AS (SELECT {series} AS series, CAST(CAST({day} AS DATE) AS TIMESTAMP) AS day, {value} AS value FROM {table}),
 span AS (SELECT min(day) AS a, max(day) AS b FROM rows),
 daily AS (SELECT g.series, g.day, m.value, date_diff('day', (SELECT a FROM span), g.day) AS i,
   date_diff('day', (SELECT a FROM span), (SELECT b FROM span)) + 1 AS n FROM (
   SELECT series, unnest(generate_series((SELECT a FROM span), (SELECT b FROM span), INTERVAL 1 DAY)) AS day FROM (SELECT DISTINCT series FROM rows)) g
   LEFT JOIN (SELECT series, day, avg(value) AS value FROM rows GROUP BY ALL) m USING (series, day))"""


_SUPPLIES = ("lineitem", "l_suppkey", "l_shipdate", "l_quantity")
_ORDERS = ("orders", "o_custkey", "o_orderdate", "o_totalprice")
_TREND_SQL = f"""WITH {_daily_sql(*_SUPPLIES)}, r AS (
 SELECT series, day, i, CASE WHEN i >= {HALF} AND i < n - {HALF} THEN avg(value) OVER (
   PARTITION BY series ORDER BY day ROWS BETWEEN {HALF} PRECEDING AND {HALF} FOLLOWING) END AS trend FROM daily)"""


def _year_trend(t):
    means, series, first, _, days = _daily(t, *_SUPPLIES)
    return windows.rolling_trend_of(
        means, series, "series", "day", "value", first, days, half=HALF), first


@query("rolling_year", _TREND_SQL + " SELECT series, day, round(trend, 6) AS trend FROM r")
def rolling_year(t):
    """Running mean of 365 days of each supplier over seven years."""
    return _year_trend(t)[0].select("series", "day", F.round("trend", 6).alias("trend"))


@query("trend_of_rolling_year", _TREND_SQL + """
SELECT series, round(regr_slope(trend, i) * 365, 6) AS trend_per_year FROM r GROUP BY series""")
def trend_of_rolling_year(t):
    """Slope per year of the smoothed series."""
    smooth, first = _year_trend(t)
    out = aggregates.trend(smooth, "series", windows.slot_number("day", first, 86_400), "trend")
    return out.select("series", F.round("trend_per_year", 6).alias("trend_per_year"))


@query("interpolate_168", f"""WITH {_daily_sql(*_ORDERS)}, near AS (
 SELECT series, day, value, i,
   last_value(value IGNORE NULLS) OVER b AS pv, last_value(CASE WHEN value IS NOT NULL THEN i END IGNORE NULLS) OVER b AS pi,
   first_value(value IGNORE NULLS) OVER a AS nv, first_value(CASE WHEN value IS NOT NULL THEN i END IGNORE NULLS) OVER a AS ni
 FROM daily WINDOW b AS (PARTITION BY series ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
   a AS (PARTITION BY series ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT series, count(v) AS n_filled, round(sum(v), 2) AS total FROM (
 SELECT series, coalesce(value, CASE WHEN pi IS NOT NULL AND ni IS NOT NULL AND i - pi <= {LIMIT} THEN pv + (nv - pv) * (i - pi) / (ni - pi) END) AS v FROM near)
GROUP BY series""")
def interpolate_168(t):
    """The first 168 slots of every gap between the orders of a customer."""
    means, series, first, last, _ = _daily(t, *_ORDERS)
    out = windows.interpolate_of(means, series, "series", "day", "value", first, last,
                                 "INTERVAL 1 DAY", seconds=86_400, limit=LIMIT)
    return out.groupBy("series").agg(
        F.count("value").alias("n_filled"), F.round(F.sum("value"), 2).alias("total")
    )


@query("stride_6000", f"""WITH n AS (
 SELECT l_linestatus AS series, l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS day,
   row_number() OVER (PARTITION BY l_linestatus ORDER BY CAST(l_shipdate AS DATE), l_orderkey, l_linenumber) - 1 AS pos,
   count(*) OVER (PARTITION BY l_linestatus) AS n FROM lineitem)
SELECT series, day, l_orderkey, l_linenumber FROM n WHERE pos % CAST(ceil(n / {POINTS}.0) AS BIGINT) = 0""")
def stride_6000(t):
    """At most 6000 evenly spaced rows of a series."""
    rows = t.lineitem.select(
        F.col("l_linestatus").alias("series"), _day("l_shipdate").alias("day"), "l_orderkey",
        "l_linenumber",
    )
    return blocks.stride_sample(
        rows, ["series"], "day", ["l_orderkey", "l_linenumber"], POINTS, seconds=86_400
    )


_LOG_SQL = """log AS (
 SELECT 'c' || (l_suppkey % 50) AS ip, l_returnflag AS store, l_partkey AS size,
   TIMESTAMP '2024-01-01' + to_seconds(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) * 400 + l_linenumber * 31) AS ts
 FROM lineitem)"""


@query("sessions_300", f"""WITH {_LOG_SQL}, s AS (
 SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL {IDLE} SECOND THEN 1 ELSE 0 END AS opens
 FROM log WINDOW w AS (PARTITION BY ip, store ORDER BY ts)),
 n AS (SELECT *, sum(opens) OVER (PARTITION BY ip, store ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM s)
SELECT ip, store, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_chunks, CAST(sum(size) AS BIGINT) AS n_bytes
FROM n GROUP BY ip, store, no""")
def sessions_300(t):
    """Sessions of a dense request log at an idle time of 300 seconds."""
    days = F.date_diff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date"))
    log = t.lineitem.select(
        F.concat(F.lit("c"), (F.col("l_suppkey") % 50).cast("string")).alias("ip"),
        F.col("l_returnflag").alias("store"), F.col("l_partkey").cast("bigint").alias("size"),
        F.timestamp_add(
            "SECOND", days * 400 + F.col("l_linenumber") * 31,
            F.lit("2024-01-01").cast("timestamp_ntz"),
        ).alias("ts"),
    )
    return sessions.sessions(log, idle=IDLE).drop("session_no")


# A grid of minutes: frames and gaps in slots.
FRAME, GAP = 240, 90


def _minutes(t):
    """The first good value of every minute of each variable, on the grid of all minutes."""
    o = A.obs(t).filter("time IS NOT NULL").select(
        "variable", clean.slot_start("time", "MINUTE").alias("minute"), "time", "seq",
        clean.mask_set("value", "qc_flag", ["U", "O"]).alias("value"),
    )
    first = joins.first_row_wins(o, ["variable", "minute"], ["time", "seq"], ["value"])
    start, last, _ = A.span(t)
    grid = joins.regular_grid(
        o.select("variable").distinct(), "variable", start, last, "INTERVAL 1 MINUTE", "minute"
    )
    return joins.reindex(grid, first, ["variable", "minute"]), start


_MINUTES_SQL = f"""{A.HOURLY_SQL}, minutes AS (
 SELECT g.variable, g.minute, f.value, date_diff('minute', {A.FIRST_SQL}, g.minute) AS i FROM (
   SELECT variable, unnest(generate_series((SELECT first FROM span), (SELECT last FROM span), INTERVAL 1 MINUTE)) AS minute
   FROM (SELECT DISTINCT variable FROM obs WHERE time IS NOT NULL)) g
 LEFT JOIN (SELECT variable, date_trunc('minute', time) AS minute, CASE WHEN qc_flag IN ('U', 'O') THEN value END AS value FROM obs
   QUALIFY row_number() OVER (PARTITION BY variable, date_trunc('minute', time) ORDER BY time, seq) = 1) f USING (variable, minute))"""


@query("rolling_minutes", f"""WITH {_MINUTES_SQL}, r AS (
 SELECT variable, minute, CASE WHEN count(value) OVER w >= 3 THEN avg(value) OVER w END AS smooth FROM minutes
 WINDOW w AS (PARTITION BY variable ORDER BY minute ROWS BETWEEN {FRAME // 2} PRECEDING AND {(FRAME - 1) // 2} FOLLOWING))
SELECT variable, CAST(minute AS DATE) AS day, count(smooth) AS n, round(sum(smooth), 3) AS total, round(max(smooth), 6) AS most FROM r GROUP BY ALL""")
def rolling_minutes(t):
    """Means of four hours on a grid of minutes."""
    grid, _ = _minutes(t)
    out = windows.rolling_day(
        grid, "variable", "minute", "value", width=FRAME, min_count=3, seconds=60
    )
    return out.groupBy("variable", F.col("minute").cast("date").alias("day")).agg(
        F.count("smooth").alias("n"), F.round(F.sum("smooth"), 3).alias("total"),
        F.round(F.max("smooth"), 6).alias("most"),
    )


@query("filled_minutes", f"""WITH {_MINUTES_SQL}, near AS (
 SELECT variable, minute, i, value,
   last_value(value IGNORE NULLS) OVER b AS pv, last_value(CASE WHEN value IS NOT NULL THEN i END IGNORE NULLS) OVER b AS pi,
   first_value(value IGNORE NULLS) OVER a AS nv, first_value(CASE WHEN value IS NOT NULL THEN i END IGNORE NULLS) OVER a AS ni
 FROM minutes WINDOW b AS (PARTITION BY variable ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
   a AS (PARTITION BY variable ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
 s1 AS (SELECT variable, minute, i, coalesce(value, CASE WHEN pi IS NOT NULL AND ni IS NOT NULL AND i - pi <= {GAP} THEN pv + (nv - pv) * (i - pi) / (ni - pi) END) AS v FROM near),
 s2 AS (SELECT variable, minute, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY variable ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
   first_value(v IGNORE NULLS) OVER (PARTITION BY variable ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS x FROM s1)
SELECT variable, CAST(minute AS DATE) AS day, count(x) AS n, round(sum(x), 3) AS total, round(min(x), 6) AS least FROM s2 GROUP BY ALL""")
def filled_minutes(t):
    """Gaps of minutes interpolated over their first slots, the rest carried both ways."""
    grid, first = _minutes(t)
    inner = windows.interpolate(grid, "variable", "minute", "value", first, seconds=60, limit=GAP)
    out = windows.fill_both_ways(inner, "variable", "minute", "value", "x", seconds=60)
    return out.groupBy("variable", F.col("minute").cast("date").alias("day")).agg(
        F.count("x").alias("n"), F.round(F.sum("x"), 3).alias("total"),
        F.round(F.min("x"), 6).alias("least"),
    )
