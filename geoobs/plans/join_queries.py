"""Product merge, scatter, coordinates and instruments (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean
from ..operators import joins
from . import adapters as A
from .registry import query

_PRODUCTS = {
    "FLUXES": ["TA", "H_QC", "NEE"], "METEO": ["TA_QC", "PA", "H_FLAG"], "FLUXNET": ["GPP", "PA_QC"],
}


def _products(t):
    """Three half-hourly products cut from the line items, each with its own columns."""
    li = t.lineitem.withColumn("site_id", F.col("l_suppkey"))
    value = {"TA": "l_quantity", "H_QC": "l_tax", "NEE": "l_extendedprice", "TA_QC": "l_discount",
             "PA": "l_quantity", "H_FLAG": "l_tax", "GPP": "l_extendedprice", "PA_QC": "l_discount"}
    flag = {"FLUXES": "A", "METEO": "N", "FLUXNET": "R"}
    out = {}
    for name, cols in _PRODUCTS.items():
        part = li.filter(F.col("l_returnflag") == flag[name])
        out[name] = part.groupBy("site_id", F.col("l_shipdate").alias("ts")).agg(
            *[F.max(value[c]).alias(c) for c in cols]
        )
    return out


def _mapping(t):
    """Header mapping; it is derived from the product tables, one row per column."""
    rows = [(p, c) for p, cols in _PRODUCTS.items() for c in cols]
    return t.spark.createDataFrame(rows, "product STRING, column STRING")


_LONG_SQL = """long AS (
  SELECT l_suppkey AS site_id, l_shipdate AS ts, 'FLUXES' AS product, 'NEE' AS column, max(l_extendedprice) AS value
  FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL
  UNION ALL SELECT l_suppkey, l_shipdate, 'FLUXNET', 'GPP', max(l_extendedprice) FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL)"""


@query("merge_products_long", f"""WITH {_LONG_SQL}
SELECT product, "column", count(*) AS n, round(avg(value), 4) AS mean_value FROM long GROUP BY ALL""")
def merge_products_long(t):
    parts = {}
    for name, df in _products(t).items():
        cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                 for c in _PRODUCTS[name]]
        parts[name] = df.select("site_id", "ts", F.explode(F.array(*cells)).alias("c")).select(
            "site_id", "ts", "c.*"
        )
    merged = joins.merge_products_long(parts, _mapping(t))
    return merged.groupBy("product", "column").agg(
        F.count("*").alias("n"), F.round(F.avg("value"), 4).alias("mean_value")
    )


@query("merge_products_wide", """
SELECT coalesce(a.site_id, n.site_id, r.site_id) AS site_id, coalesce(a.ts, n.ts, r.ts) AS ts, a.nee AS "NEE", r.gpp AS "GPP"
FROM (SELECT l_suppkey AS site_id, l_shipdate AS ts, max(l_extendedprice) AS nee FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL) a
FULL JOIN (SELECT DISTINCT l_suppkey AS site_id, l_shipdate AS ts FROM lineitem WHERE l_returnflag = 'N') n
  ON a.site_id = n.site_id AND a.ts = n.ts
FULL JOIN (SELECT l_suppkey AS site_id, l_shipdate AS ts, max(l_extendedprice) AS gpp FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL) r
  ON coalesce(a.site_id, n.site_id) = r.site_id AND coalesce(a.ts, n.ts) = r.ts""")
def merge_products_wide(t):
    parts = _products(t)
    return joins.merge_products_wide(
        [parts["FLUXES"], parts["METEO"], parts["FLUXNET"]], ["site_id", "ts"]
    )


@query("scatter_union_times", f"""WITH {A.OBS_SQL}, cells AS (
  SELECT date_trunc('day', time)::TIMESTAMP AS ts, variable, value FROM obs
  QUALIFY row_number() OVER (PARTITION BY date_trunc('day', time), variable ORDER BY time DESC, seq DESC) = 1)
SELECT s.variable, x.ts, c.value FROM (SELECT DISTINCT ts FROM cells) x
CROSS JOIN (SELECT DISTINCT variable FROM obs) s LEFT JOIN cells c ON c.ts = x.ts AND c.variable = s.variable""")
def scatter_union_times(t):
    o = A.obs(t).withColumn("ts", clean.slot_start("time", "DAY"))
    axis = ["click", "error", "purchase", "signup", "view"]
    return joins.scatter(o, "variable", "ts", "value", ["time", "seq"], axis)


@query("last_row_wins", f"""WITH {A.OBS_SQL}
SELECT station_id, date_trunc('hour', time)::TIMESTAMP AS hour, seq, value FROM obs
QUALIFY row_number() OVER (PARTITION BY station_id, date_trunc('hour', time) ORDER BY seq DESC) = 1""")
def last_row_wins(t):
    o = A.obs(t).withColumn("hour", clean.hour_floor("time"))
    return joins.last_row_wins(o, ["station_id", "hour"], ["seq"], ["seq", "value"])


@query("first_row_wins", f"""WITH {A.OBS_SQL}
SELECT variable, date_trunc('hour', time)::TIMESTAMP AS hour, seq, value FROM obs
QUALIFY row_number() OVER (PARTITION BY variable, date_trunc('hour', time) ORDER BY time, seq) = 1""")
def first_row_wins(t):
    o = A.obs(t).withColumn("hour", clean.hour_floor("time"))
    return joins.first_row_wins(o, ["variable", "hour"], ["time", "seq"], ["seq", "value"])


@query("station_coordinates", f"""WITH {A.OBS_SQL}, {A.STATIONS_SQL}
SELECT s.country, count(*) AS n, round(avg(s.lat), 6) AS mean_lat, round(avg(s.lon), 6) AS mean_lon, max(s.altitude) AS top
FROM obs LEFT JOIN stations s USING (station_id) GROUP BY s.country""")
def station_coordinates(t):
    o = joins.with_station(
        A.obs(t), A.stations(t), "station_id", "lat", "lon", "country", "altitude"
    )
    return o.groupBy("country").agg(
        F.count("*").alias("n"), F.round(F.avg("lat"), 6).alias("mean_lat"),
        F.round(F.avg("lon"), 6).alias("mean_lon"), F.max("altitude").alias("top"),
    )


@query("position_fallback", f"""WITH {A.TRACK_SQL}, {A.STATIONS_SQL}
SELECT deployment, count(lat2) AS n_positions, round(avg(lat2), 6) AS mean_lat, round(avg(lon2), 6) AS mean_lon FROM (
  SELECT t.deployment, CASE WHEN t.deployment % 5 <> 0 THEN CASE WHEN lon_qc BETWEEN 0 AND 2 AND lat_qc BETWEEN 0 AND 2 THEN t.lat END ELSE s.lat END AS lat2,
         CASE WHEN t.deployment % 5 <> 0 THEN CASE WHEN lon_qc BETWEEN 0 AND 2 AND lat_qc BETWEEN 0 AND 2 THEN t.lon END ELSE s.lon END AS lon2
  FROM track t LEFT JOIN stations s ON s.station_id = t.deployment) GROUP BY deployment""")
def position_fallback(t):
    dim = A.stations(t).select(
        F.col("station_id").alias("deployment"), "lat", "lon",
        (F.col("station_id") % 5 != 0).alias("has_position"),
    )
    p = joins.with_position_fallback(A.track(t), dim)
    return p.groupBy("deployment").agg(
        F.count("lat").alias("n_positions"), F.round(F.avg("lat"), 6).alias("mean_lat"),
        F.round(F.avg("lon"), 6).alias("mean_lon"),
    )


@query("restrict_members", """
SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)
GROUP BY l_suppkey""")
def restrict_members(t):
    wanted = t.supplier.filter("s_acctbal > 5000").select(F.col("s_suppkey").alias("l_suppkey"))
    return joins.restrict(t.lineitem, wanted, "l_suppkey").groupBy("l_suppkey").agg(
        F.count("*").alias("n")
    )


@query("unmatched_stations", """
SELECT c_custkey AS o_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT -1 FROM nation WHERE n_nationkey = 0""")
def unmatched_stations(t):
    wanted = t.customer.select(F.col("c_custkey").alias("o_custkey")).union(
        t.nation.filter("n_nationkey = 0").select(F.lit(-1).cast("bigint"))
    )
    return joins.unmatched(wanted, t.orders, "o_custkey")


@query("best_product", """
SELECT freq, variable, arg_min(product, (CASE WHEN product LIKE '%FLUXNET%' THEN 0 WHEN product LIKE '%FLUXES%' THEN 1 WHEN product LIKE '%METEOSENS%' THEN 2 WHEN product LIKE '%METEO%' THEN 3 ELSE 99 END, product)) AS product
FROM (SELECT l_linestatus AS freq, CAST(l_linenumber AS VARCHAR) AS variable,
  CASE WHEN l_shipdate < TIMESTAMP '1996-01-01' AND l_linenumber < 3 THEN 'FLUXNET'
       WHEN l_returnflag = 'A' AND l_linenumber < 5 THEN 'FLUXES' WHEN l_returnflag = 'N' THEN 'METEOSENS' ELSE 'METEO' END AS product
  FROM lineitem) GROUP BY ALL""")
def best_product(t):
    product = (
        F.when((F.col("l_shipdate") < "1996-01-01") & (F.col("l_linenumber") < 3), "FLUXNET")
        .when((F.col("l_returnflag") == "A") & (F.col("l_linenumber") < 5), "FLUXES")
        .when(F.col("l_returnflag") == "N", "METEOSENS").otherwise("METEO")
    )
    m = t.lineitem.select(
        F.col("l_linestatus").alias("freq"), F.col("l_linenumber").cast("string").alias("variable"),
        product.alias("product"),
    )
    return joins.keep_best_product(m)


def _deployments(t):
    """Instruments per supplier and position; some are still mounted."""
    p = t.part
    return p.select(
        (F.col("p_partkey") % 100).alias("site_id"), F.lit("ta").alias("base"),
        F.lit("x").alias("column"), F.lit(1).alias("r"), (F.col("p_size") % 3).alias("h"),
        F.lit(2).alias("v"), F.col("p_name").alias("instrument"),
        F.col("p_retailprice").alias("lat"), F.col("p_retailprice").alias("lon"),
        F.col("p_partkey").cast("double").alias("alt"),
        F.timestamp_add("DAY", F.col("p_partkey") % 1500, F.lit("1995-01-01").cast("timestamp_ntz"))
        .alias("start"),
        F.when(F.col("p_size") % 4 != 0, F.timestamp_add(
            "DAY", F.col("p_partkey") % 1500 + F.col("p_size") * 10,
            F.lit("1995-01-01").cast("timestamp_ntz"))).alias("stop"),
    )


_DEPLOYMENTS_SQL = """dep AS (
  SELECT p_partkey % 100 AS site_id, p_size % 3 AS h, p_name AS instrument, p_partkey,
    TIMESTAMP '1995-01-01' + to_days(CAST(p_partkey % 1500 AS INTEGER)) AS start,
    CASE WHEN p_size % 4 <> 0 THEN TIMESTAMP '1995-01-01' + to_days(CAST(p_partkey % 1500 + p_size * 10 AS INTEGER)) END AS stop
  FROM part)"""


@query("variable_instruments", f"""WITH {_DEPLOYMENTS_SQL}
SELECT site_id, 'TA' AS variable, count(*) AS n_instruments FROM dep GROUP BY site_id""")
def variable_instruments(t):
    v = _deployments(t).select("site_id", F.lit("TA").alias("base"), "r", "h", "v").distinct()
    out = joins.instruments_of_variables(v.withColumn("variable", F.lit("TA")), _deployments(t))
    n = F.size(F.from_json("instrument_deployments", "array<struct<r: int>>")).cast("bigint")
    return out.select("site_id", "variable", n.alias("n_instruments"))


@query("active_instruments", f"""WITH {_DEPLOYMENTS_SQL}
SELECT s.site_id, s.h, d.instrument, count(*) AS n, max(s.l_shipdate) AS last_used FROM (
  SELECT l_orderkey, l_linenumber, l_suppkey % 100 AS site_id, l_linenumber % 3 AS h, l_shipdate FROM lineitem) s
JOIN dep d ON d.site_id = s.site_id AND d.h = s.h AND s.l_shipdate >= d.start AND (d.stop IS NULL OR s.l_shipdate < d.stop)
GROUP BY ALL""")
def active_instruments(t):
    """Observations of one position at one time are added up first, so the join grows with the positions'
    times and instruments, not with the product of both tables. Instruments of one name that are mounted
    alike are one row with a weight, for the same reason."""
    position = ["site_id", "h"]
    o = t.lineitem.select(
        (F.col("l_suppkey") % 100).alias("site_id"), (F.col("l_linenumber") % 3).alias("h"), "l_shipdate",
    ).groupBy(*position, "l_shipdate").agg(F.count("*").alias("n_obs"))
    alike = _deployments(t).groupBy(*position, "instrument", "start", "stop").agg(
        F.count("*").alias("n_mounted"))
    mounted = alike.withColumn("instrument", F.struct("instrument", "n_mounted"))
    out = joins.active_instrument(o, mounted, position, "l_shipdate")
    return out.groupBy(*position, F.col("instrument.instrument").alias("instrument")).agg(
        F.sum(F.col("n_obs") * F.col("instrument.n_mounted")).alias("n"),
        F.max("l_shipdate").alias("last_used"),
    )


@query("first_source", """
SELECT l_suppkey AS station_id, arg_min(l_returnflag, (prio, l_orderkey)) AS found, arg_min(l_orderkey, (prio, l_orderkey)) AS source FROM (
  SELECT *, CASE l_returnflag WHEN 'N' THEN 0 WHEN 'R' THEN 1 ELSE 2 END AS prio FROM lineitem)
WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY l_suppkey""")
def first_source(t):
    prio = F.when(F.col("l_returnflag") == "N", 0).when(F.col("l_returnflag") == "R", 1).otherwise(2)
    c = t.lineitem.select(
        F.col("l_suppkey").alias("station_id"), F.col("l_returnflag").alias("found"),
        F.col("l_orderkey").alias("source"), F.struct(prio.alias("p"), "l_orderkey").alias("prio"),
    )
    wanted = t.supplier.filter("s_acctbal > 0").select(F.col("s_suppkey").alias("station_id"))
    return joins.first_source(c, wanted, "station_id", "prio", ["found", "source"])


@query("climatology_fill", f"""WITH {A.HOURLY_SQL}
SELECT variable, hour, round(coalesce(value, avg(value) OVER (PARTITION BY variable, dayofyear(hour))), 6) AS filled FROM hourly""")
def climatology_fill(t):
    out = joins.climatology_fill(A.hourly(t), "variable", "hour", "value", "filled")
    return out.select("variable", "hour", F.round("filled", 6).alias("filled"))


@query("grid_mismatches", """
WITH g AS (SELECT vec_id AS file, -25.0::DOUBLE + CASE WHEN label = 3 THEN 0.5 ELSE 0 END AS x0, 0.01::DOUBLE AS dx,
  72.0::DOUBLE AS y0, -0.01::DOUBLE AS dy, len(embedding) AS width, 8 AS height FROM embeddings),
 f AS (SELECT * FROM g ORDER BY file LIMIT 1)
SELECT g.file FROM g, f WHERE abs(g.x0 - f.x0) > 1e-9 + 1e-5 * abs(f.x0) OR g.width <> f.width""")
def grid_mismatches(t):
    g = t.embeddings.select(
        F.col("vec_id").alias("file"),
        (F.lit(-25.0) + F.when(F.col("label") == 3, 0.5).otherwise(0.0)).alias("x0"),
        F.lit(0.01).alias("dx"), F.lit(72.0).alias("y0"), F.lit(-0.01).alias("dy"),
        F.size("embedding").alias("width"), F.lit(8).alias("height"),
    )
    return joins.grid_mismatches(g, "file").select("file")


@query("regular_grid", f"""WITH {A.HOURLY_SQL}
SELECT variable, count(*) AS n_slots, count(value) AS n_obs, min(hour) AS first, max(hour) AS last FROM hourly GROUP BY variable""")
def regular_grid(t):
    return A.hourly(t).groupBy("variable").agg(
        F.count("*").alias("n_slots"), F.count("value").alias("n_obs"),
        F.min("hour").alias("first"), F.max("hour").alias("last"),
    )


