"""Summaries of stations, tracks, products and stores (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean
from ..operators import aggregates, joins, percentiles, reshape, select
from . import adapters as A
from .registry import query


@query("pooled_summary", f"""WITH {A.TRACK_SQL}
SELECT round(avg(value), 6) AS mean_value, min(value) AS min_value, max(value) AS max_value, count(value) AS n_obs
FROM track WHERE qc BETWEEN 0 AND 2 AND lat BETWEEN 0 AND 20""")
def pooled_summary(t):
    tr = A.track(t).filter(F.col("qc").between(0, 2) & F.col("lat").between(0, 20))
    return aggregates.pooled_summary(tr, "value").withColumn(
        "mean_value", F.round("mean_value", 6)
    )


@query("mean_over_time", f"""WITH {A.OBS_SQL}
SELECT station_id, round(avg(value), 6) AS mean_value FROM obs GROUP BY station_id""")
def mean_over_time(t):
    return aggregates.mean_by(A.obs(t), ["station_id"], "value").withColumn(
        "mean_value", F.round("mean_value", 6)
    )


@query("mean_over_stations", f"""WITH {A.OBS_SQL}
SELECT date_trunc('hour', time)::TIMESTAMP AS hour, round(avg(value), 6) AS mean_value FROM obs GROUP BY 1""")
def mean_over_stations(t):
    o = A.obs(t).withColumn("hour", clean.hour_floor("time"))
    return aggregates.mean_by(o, ["hour"], "value").withColumn(
        "mean_value", F.round("mean_value", 6)
    )


@query("constant_columns", """
SELECT l_orderkey, c AS "column", n = 0 OR (n = total AND lo = hi) AS is_constant, CASE WHEN n = 0 OR (n = total AND lo = hi) THEN lo END AS value
FROM (SELECT l_orderkey, unnest(['l_linestatus', 'l_returnflag', 'dated']) AS c,
  unnest([count(l_linestatus), count(l_returnflag), count(CASE WHEN l_tax > 0.04 THEN l_linestatus END)]) AS n, count(*) AS total,
  unnest([min(l_linestatus), min(l_returnflag), min(CASE WHEN l_tax > 0.04 THEN l_linestatus END)]) AS lo,
  unnest([max(l_linestatus), max(l_returnflag), max(CASE WHEN l_tax > 0.04 THEN l_linestatus END)]) AS hi
  FROM lineitem GROUP BY l_orderkey)""")
def constant_columns(t):
    li = t.lineitem.withColumn("dated", F.when(F.col("l_tax") > 0.04, F.col("l_linestatus")))
    return aggregates.constant_columns(
        li, ["l_orderkey"], ["l_linestatus", "l_returnflag", "dated"]
    )


@query("fixed_or_moving", f"""WITH {A.TRACK_SQL}
SELECT deployment, CASE WHEN deployment % 11 = 3 THEN true WHEN deployment % 11 = 4 THEN false
  ELSE stddev_pop(lon) < 0.001 AND stddev_pop(lat) < 0.001 END AS fixed FROM track GROUP BY deployment""")
def fixed_or_moving(t):
    geo = F.when(F.col("deployment") % 11 == 3, "Point").when(
        F.col("deployment") % 11 == 4, "LineString"
    )
    return aggregates.fixed_deployments(A.track(t).withColumn("geo_type", geo))


@query("static_positions", f"""WITH {A.TRACK_SQL}
SELECT deployment, round(median(lon), 6) AS static_lon, round(median(lat), 6) AS static_lat FROM track GROUP BY deployment""")
def static_positions(t):
    p = aggregates.static_position(A.track(t), "deployment", "lon", "lat")
    return p.select(
        "deployment", F.round("static_lon", 6).alias("static_lon"),
        F.round("static_lat", 6).alias("static_lat"),
    )


@query("colour_bounds", f"""WITH {A.TRACK_SQL}
SELECT variable, round(CASE WHEN hi <= lo THEN mn ELSE lo END, 6) AS vmin, round(CASE WHEN hi <= lo THEN CASE WHEN mx > mn THEN mx ELSE mn + 1 END ELSE hi END, 6) AS vmax
FROM (SELECT variable, quantile_cont(value, 0.02) AS lo, quantile_cont(value, 0.98) AS hi, min(value) AS mn, max(value) AS mx FROM track GROUP BY variable)""")
def colour_bounds(t):
    b = percentiles.colour_bounds(A.track(t), ["variable"], "value")
    return b.select("variable", F.round("vmin", 6).alias("vmin"), F.round("vmax", 6).alias("vmax"))


@query("pooled_percentiles", """
SELECT round(quantile_cont(l_extendedprice, 0.25), 6) AS q25, round(quantile_cont(l_extendedprice, 0.5), 6) AS q50, round(quantile_cont(l_extendedprice, 0.999), 6) AS q999
FROM lineitem""")
def pooled_percentiles(t):
    p = percentiles.exact_percentiles(
        t.lineitem, [], "l_extendedprice", {"q25": 0.25, "q50": 0.5, "q999": 0.999}
    )
    return p.select(*[F.round(c, 6).alias(c) for c in ("q25", "q50", "q999")])


@query("daily_mean_bounds", f"""WITH {A.DAILY_SQL}
SELECT variable, round(quantile_cont(value, 0.01), 6) AS low, round(quantile_cont(value, 0.92), 6) AS high FROM daily GROUP BY variable""")
def daily_mean_bounds(t):
    p = percentiles.exact_percentiles(
        A.daily(t), ["variable"], "value", {"low": 0.01, "high": 0.92}
    )
    return p.select("variable", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


@query("common_variables", f"""WITH {A.OBS_SQL}
SELECT variable, count(DISTINCT station_id) AS n_stations FROM obs GROUP BY variable
HAVING count(DISTINCT station_id) = (SELECT count(DISTINCT station_id) FROM obs)""")
def common_variables(t):
    return aggregates.common_variables(A.obs(t), "station_id", "variable")


@query("shared_names", """
SELECT name, count(DISTINCT product) AS n_products FROM (
  SELECT l_returnflag AS product, 'V' || l_linenumber AS name FROM lineitem) GROUP BY name HAVING count(DISTINCT product) > 1""")
def shared_names(t):
    suffix = F.when(F.col("l_linestatus") == "O", "_QC").otherwise(
        F.when(F.col("l_quantity") > 25, "_FLAG").otherwise(""))
    m = t.lineitem.select(
        F.col("l_returnflag").alias("product"),
        F.concat(F.lit("V"), F.col("l_linenumber").cast("string"), suffix).alias("column"),
    )
    return aggregates.shared_names(m, joins.normal_name("column"))


@query("coverage_table", f"""WITH {A.GAS_SQL}
SELECT station_id, gas, min(time) AS start, max(time) AS stop,
  CAST(floor(date_diff('microsecond', min(time), max(time)) / 86400000000) AS BIGINT) AS duration_days
FROM gas_rows WHERE gas IS NOT NULL GROUP BY ALL""")
def coverage_table(t):
    return aggregates.coverage(
        A.gas_rows(t).filter("gas IS NOT NULL"), ["station_id", "gas"], "time"
    )


@query("site_rollup", f"""WITH {A.GAS_SQL}, p AS (SELECT DISTINCT trigram, height, gas FROM gas_rows WHERE gas IS NOT NULL)
SELECT trigram, height, array_to_string(list_filter(['co2','ch4','n2o','co'], lambda g: list_contains(list(gas), g)), ',') AS gases,
  (SELECT count(DISTINCT height) FROM p q WHERE q.trigram = p.trigram) AS n_heights,
  (SELECT array_to_string(list_filter(['co2','ch4','n2o','co'], lambda g: list_contains(list(q.gas), g)), ',') FROM p q WHERE q.trigram = p.trigram) AS site_gases
FROM p GROUP BY trigram, height""")
def site_rollup(t):
    g = A.gas_rows(t).filter("gas IS NOT NULL")
    r = aggregates.site_rollup(g, "trigram", "height", "gas")
    return r.select(
        "trigram", "height", F.array_join("gases", ",").alias("gases"), "n_heights",
        F.array_join("site_gases", ",").alias("site_gases"),
    )


@query("platform_catalogue", f"""WITH {A.TRACK_SQL}
SELECT CASE WHEN deployment % 9 = 0 THEN CASE WHEN deployment % 2 = 0 THEN '(unknown)' ELSE 'ship' || (deployment % 4) END ELSE 'P' || (deployment % 9) END AS platform,
  deployment, min(time) AS time_start, max(time) AS time_end, false AS fixed, count(*) AS n_rows FROM track GROUP BY deployment""")
def platform_catalogue(t):
    d = F.col("deployment")
    dep = A.track(t).groupBy("deployment").agg(
        F.min("time").alias("time_start"), F.max("time").alias("time_end"),
        F.count("*").alias("n_rows"),
    ).withColumns({
        "fixed": F.lit(False),
        "station_id": F.when(d % 9 == 0, "").otherwise(
            F.concat(F.lit("P"), (d % 9).cast("string"))),
        "platform_name": F.when(d % 2 != 0, F.concat(F.lit("ship"), (d % 4).cast("string"))),
    })
    return aggregates.platform_catalogue(dep)


@query("daily_means", f"""WITH {A.HOURLY_SQL}
SELECT variable, date_trunc('day', hour)::TIMESTAMP AS day, round(avg(value), 6) AS mean_value, count(value) AS n_obs FROM hourly GROUP BY ALL""")
def daily_means(t):
    d = aggregates.slot_means(A.hourly(t), ["variable"], "hour", "value", "DAY", "day")
    return d.withColumn("mean_value", F.round("mean_value", 6))


@query("monthly_profile_means", """
SELECT l_linenumber AS h, date_trunc('month', l_shipdate)::TIMESTAMP AS month, round(avg(nullif(v, -9999)), 6) AS mean_value, count(nullif(v, -9999)) AS n_obs
FROM (SELECT *, CASE WHEN l_tax = 0 THEN -9999 ELSE l_quantity END AS v FROM lineitem) GROUP BY ALL HAVING count(nullif(v, -9999)) > 0""")
def monthly_profile_means(t):
    v = clean.clean_value(F.when(F.col("l_tax") == 0, -9999.0).otherwise(F.col("l_quantity")))
    rows = t.lineitem.select(F.col("l_linenumber").alias("h"), "l_shipdate", v.alias("value"))
    m = aggregates.slot_means(rows, ["h"], "l_shipdate", "value", "MONTH", "month")
    return m.filter("n_obs > 0").withColumn("mean_value", F.round("mean_value", 6))


@query("trend_per_year", """
SELECT l_suppkey AS station_id, round(regr_slope(l_quantity, date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE))) * 365, 6) AS trend_per_year
FROM lineitem GROUP BY 1""")
def trend_per_year(t):
    li = t.lineitem.withColumnRenamed("l_suppkey", "station_id")
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1995-01-01").cast("date"))
    out = aggregates.trend(li, "station_id", day, "l_quantity")
    return out.withColumn("trend_per_year", F.round("trend_per_year", 6))


@query("seasonal_extremes", """
WITH d AS (SELECT l_returnflag AS station_id, l_shipdate AS day, round(avg(l_quantity), 6) AS value FROM lineitem GROUP BY ALL),
 y AS (SELECT station_id, arg_min(yr, (yr <> 1998, -n, yr)) AS ref_year FROM (SELECT station_id, CAST(year(day) AS INTEGER) AS yr, count(*) AS n FROM d GROUP BY ALL) GROUP BY station_id)
SELECT station_id, ref_year, arg_min(day, (-value, day)) FILTER (WHERE month(day) IN (12, 1, 2)) AS winter_day, max(value) FILTER (WHERE month(day) IN (12, 1, 2)) AS winter_max,
  arg_min(day, (value, day)) FILTER (WHERE month(day) IN (6, 7, 8)) AS summer_day, min(value) FILTER (WHERE month(day) IN (6, 7, 8)) AS summer_min
FROM d JOIN y USING (station_id) WHERE year(day) = ref_year GROUP BY ALL""")
def seasonal_extremes(t):
    d = t.lineitem.groupBy(
        F.col("l_returnflag").alias("station_id"), F.col("l_shipdate").alias("day")
    ).agg(F.round(F.avg("l_quantity"), 6).alias("value"))
    return aggregates.seasonal_extremes(d, "station_id", "day", "value", prefer=1998)


@query("coverage_percent", f"""WITH {A.HOURLY_SQL}
SELECT variable, count(*) AS n_slots, count(value) AS n_obs, round(100.0 * count(value) / count(*), 6) AS coverage_pct, min(value) AS min_value, max(value) AS max_value
FROM hourly GROUP BY variable""")
def coverage_percent(t):
    c = aggregates.coverage_percent(A.hourly(t), "variable", "value")
    return c.withColumn("coverage_pct", F.round("coverage_pct", 6))


@query("flag_sets", f"""WITH {A.OBS_SQL}
SELECT station_id, string_agg(DISTINCT qc_flag, '' ORDER BY qc_flag) AS flags FROM obs GROUP BY station_id""")
def flag_sets(t):
    f = aggregates.flag_sets(A.obs(t), "station_id", "qc_flag")
    return f.withColumn("flags", F.array_join("flags", ""))


@query("annual_budget", """
SELECT 'S' || l_suppkey AS site_id, CAST(year(l_shipdate) AS INTEGER) AS year, max(l_quantity) AS nee,
  max(CASE WHEN l_tax <> 0 THEN l_extendedprice END) AS gpp, NULL::DOUBLE AS reco FROM lineitem
WHERE l_tax <> 0 GROUP BY ALL""")
def annual_budget(t):
    w = A.wide_flux(t)
    roles = reshape.classify_columns([c for c in w.columns if c not in A.WIDE_KEYS])
    long = reshape.to_long(w, A.WIDE_KEYS, reshape.pick(roles, "NEE", "GPP", "RECO"))
    return aggregates.annual_budget(long.filter("value IS NOT NULL"))


@query("extents", f"""WITH {A.OBS_SQL}
SELECT count(DISTINCT station_id) AS n_stations, min(time) AS time_min, max(time) AS time_max FROM obs""")
def extents(t):
    return aggregates.extents(A.obs(t), "station_id", "time")


@query("track_viewports", f"""WITH {A.TRACK_SQL}
SELECT deployment, round(w - pl, 6) AS west, round(e + pl, 6) AS east, round(s - pa, 6) AS south, round(n + pa, 6) AS north,
  round((s + n) / 2, 6) AS centre_lat, round((w + e) / 2, 6) AS centre_lon FROM (
  SELECT *, greatest(2.0, (e - w) * 0.1::DOUBLE) AS pl, greatest(1.0, (n - s) * 0.1::DOUBLE) AS pa FROM (
    SELECT deployment, min(lon) AS w, max(lon) AS e, min(lat) AS s, max(lat) AS n FROM track GROUP BY deployment))""")
def track_viewports(t):
    v = aggregates.viewport(A.track(t), ["deployment"], "lon", "lat")
    return v.select("deployment", *[F.round(c, 6).alias(c) for c in v.columns[1:]])


@query("files_per_month", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(DISTINCT o_orderdate) AS n_days, count(*) AS n_files,
  CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS bytes FROM orders GROUP BY ALL""")
def files_per_month(t):
    o = t.orders.withColumn("size", F.floor("o_totalprice").cast("bigint"))
    return aggregates.files_per_month(o, "o_orderdate", "size")


@query("store_inventory", f"""WITH {A.WIDE_SQL}, long AS (
  SELECT product, 'TA' AS variable, 3 AS dims, '1' AS k FROM wide UNION ALL SELECT product, 'CO2_DRY', 1, l FROM wide, (SELECT unnest(['7', '9']) AS l))
SELECT product, variable, count(*) AS n_rows, count(DISTINCT k) AS n_combos, CAST(1 + max(dims) AS INTEGER) AS n_dims FROM long GROUP BY ALL""")
def store_inventory(t):
    w = A.wide_flux(t)
    roles = reshape.classify_columns([c for c in w.columns if c not in A.WIDE_KEYS])
    long = reshape.to_long(w, A.WIDE_KEYS, reshape.pick(roles, "TA", "CO2_DRY"))
    from .. import schema as S

    return aggregates.store_inventory(long, ["product"], "variable", S.FLUX_LABELS)


@query("flagged_station_counts", f"""WITH {A.OBS_SQL}
SELECT station_id, count(*) AS n FROM obs WHERE qc_flag IN ('U', 'O') AND station_id IN (SELECT station_id FROM obs WHERE variable = 'view') GROUP BY station_id""")
def flagged_station_counts(t):
    o = A.obs(t)
    seen = select.labels(o, variable="view").select("station_id").distinct()
    return select.labels(o, qc_flag=["U", "O"]).join(seen, "station_id", "left_semi").groupBy(
        "station_id"
    ).agg(F.count("*").alias("n"))
