"""Space, time, label and position selections, and set operations (B29-B34, G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean
from ..operators import aggregates, blocks, joins, select
from . import adapters as A
from .registry import query

BOX = dict(south=40.0, north=60.0, west=-5.0, east=20.0)
BOX_SQL = "lat BETWEEN 40 AND 60 AND lon BETWEEN -5 AND 20"


@query("station_box_summary", f"""WITH {A.OBS_SQL}, {A.STATIONS_SQL}
SELECT station_id, name, lat, lon, height, count(v) AS n_obs, round(avg(v), 6) AS mean_value
FROM (SELECT s.*, CASE WHEN o.qc BETWEEN 0 AND 2 THEN o.value END AS v FROM obs o JOIN stations s USING (station_id)
      WHERE {BOX_SQL} AND time >= TIMESTAMP '2024-01-05' AND time < TIMESTAMP '2024-01-26')
GROUP BY ALL""")
def station_box_summary(t):
    """Flagship: bounding box and period over facts, masked, summarised per station.

    The boxed stations restrict the facts before anything is summed up, which also lets Spark prune
    the scan by them; sums per station are made map-side, so raw rows are not shuffled where the
    stations of the box can be broadcast.
    """
    dim = select.stations_in_box(A.stations(t), **BOX).select(
        "station_id", "name", "lat", "lon", "height"
    )
    boxed = A.obs(t).join(dim.select("station_id"), "station_id", "left_semi")
    o = select.time_slice(boxed, "time", "2024-01-05", "2024-01-25")
    masked = o.withColumn("v", clean.mask_range("value", "qc"))
    out = select.facts_of(aggregates.station_summary(masked, "station_id", "v"), dim)
    return out.withColumn("mean_value", F.round("mean_value", 6))


@query("row_box", f"""WITH {A.TRACK_SQL}
SELECT deployment, count(*) AS n_rows, min(lon) AS west, max(lon) AS east FROM track
WHERE lat BETWEEN 0 AND 20 AND lon BETWEEN -10 AND 10 GROUP BY deployment""")
def row_box(t):
    inside = A.track(t).filter(select.in_box("lat", "lon", 0.0, 20.0, -10.0, 10.0))
    return inside.groupBy("deployment").agg(
        F.count("*").alias("n_rows"), F.min("lon").alias("west"), F.max("lon").alias("east")
    )


@query("time_slice_partial", f"""WITH {A.OBS_SQL}
SELECT CAST(time AS DATE) AS day, count(*) AS n FROM obs
WHERE time >= TIMESTAMP '2024-01-01' AND time < TIMESTAMP '2024-01-16' GROUP BY 1""")
def time_slice_partial(t):
    o = select.time_slice(A.obs(t), "time", "2024-01", "2024-01-15")
    return o.groupBy(F.col("time").cast("date").alias("day")).agg(F.count("*").alias("n"))


@query("label_selection", f"""WITH {A.WIDE_SQL}
SELECT site_id, ts_start, avg(nullif("NEE_VUT_REF", -9999)) AS value FROM wide GROUP BY ALL
HAVING count(nullif("NEE_VUT_REF", -9999)) > 0""")
def label_selection(t):
    from ..operators import reshape

    w = A.wide_flux(t)
    roles = reshape.classify_columns([c for c in w.columns if c not in A.WIDE_KEYS])
    nee = reshape.pick(roles, "NEE")
    long = reshape.to_long(w, A.WIDE_KEYS, nee)
    chosen = select.labels(
        long, variable="NEE", ustar_threshold="VUT", nee_variant=["REF"]
    ).filter(F.col("value").isNotNull())
    return chosen.groupBy("site_id", "ts_start").agg(F.avg("value").alias("value"))


@query("position_slice", f"""WITH {A.OBS_SQL}
SELECT station_id, seq, time FROM obs QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY time, seq) - 1 BETWEEN 10 AND 39""")
def position_slice(t):
    return blocks.rows_between(A.obs(t), ["station_id"], "time", ["seq"], 10, 40).select(
        "station_id", "seq", "time"
    )


@query("station_match", f"""WITH {A.STATIONS_SQL}
SELECT station_id, trigram, name FROM stations
WHERE trigram IN ('AUT', 'BUI') AND regexp_matches(name, '[02468]$') AND name LIKE 'Customer%'""")
def station_match(t):
    return select.station_match(
        A.stations(t), "trigram", ids=["aut", "Bui"]
    ).transform(lambda d: select.station_match(d, "name", prefix="Customer", pattern="[02468]$")
                ).select("station_id", "trigram", "name")


@query("mask_extent", f"""WITH {A.STATIONS_SQL}
SELECT min(lat) AS lat_min, max(lat) AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max
FROM stations WHERE altitude > 5000""")
def mask_extent(t):
    return select.mask_extent(A.stations(t), F.col("altitude") > 5000, "lat", "lon")


@query("ordered_stations", f"""WITH {A.STATIONS_SQL}
SELECT trigram, height, station_id FROM stations ORDER BY trigram, height DESC, station_id""")
def ordered_stations(t):
    return A.stations(t).select("trigram", "height", "station_id").orderBy(
        "trigram", F.desc("height"), "station_id"
    )


@query("extreme_rows", f"""WITH {A.OBS_SQL}
SELECT variable, arg_max(time, (value, -seq)) AS max_time, max(value) AS max_value,
       arg_min(time, (value, seq)) AS min_time, min(value) AS min_value FROM obs GROUP BY variable""")
def extreme_rows(t):
    return A.obs(t).groupBy("variable").agg(
        F.max_by("time", F.struct("value", -F.col("seq"))).alias("max_time"),
        F.max("value").alias("max_value"),
        F.min_by("time", F.struct("value", "seq")).alias("min_time"),
        F.min("value").alias("min_value"),
    )


@query("head_rows", f"""WITH {A.OBS_SQL}
SELECT time, variable, value FROM obs ORDER BY time, seq LIMIT 5""")
def head_rows(t):
    return A.obs(t).orderBy("time", "seq").limit(5).select("time", "variable", "value")


@query("union_times", """
SELECT o_orderdate AS ts FROM orders UNION SELECT l_shipdate FROM lineitem""")
def union_times(t):
    return joins.union_times([
        t.orders.select(F.col("o_orderdate").alias("ts")),
        t.lineitem.select(F.col("l_shipdate").alias("ts")),
    ], "ts")


@query("variable_intersection", f"""WITH {A.OBS_SQL}
SELECT DISTINCT variable FROM obs WHERE qc = 0 INTERSECT SELECT DISTINCT variable FROM obs WHERE qc = 2""")
def variable_intersection(t):
    o = A.obs(t)
    return o.filter("qc = 0").select("variable").intersect(o.filter("qc = 2").select("variable"))


@query("inventory_difference", f"""WITH {A.OBS_SQL},
 b AS (SELECT DISTINCT station_id, variable FROM obs WHERE time < TIMESTAMP '2024-01-04'),
 a AS (SELECT DISTINCT station_id, variable FROM obs WHERE time >= TIMESTAMP '2024-01-28')
SELECT *, 'added' AS change FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT *, 'removed' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def inventory_difference(t):
    from ..operators import catalog

    o = A.obs(t)
    before = select.time_slice(o, "time", None, "2024-01-03").select("station_id", "variable")
    after = select.time_slice(o, "time", "2024-01-28", None).select("station_id", "variable")
    return catalog.inventory_changes(before.distinct(), after.distinct())


@query("first_five_names", f"""WITH {A.SESSIONS_SQL}
SELECT ip, array_to_string(list_sort(list(DISTINCT array_name))[1:5], ', ') AS names
FROM tracked WHERE array_name IS NOT NULL GROUP BY ip""")
def first_five_names(t):
    from ..operators import sessions

    # Arrays of the store are a short vocabulary, so the set of one client is bounded by it.
    c = sessions.tracked(A.access(t)).filter("array IS NOT NULL")
    return c.groupBy("ip").agg(
        F.array_join(F.slice(F.sort_array(F.collect_set("array")), 1, 5), ", ").alias("names")
    )


@query("selection_chain", f"""WITH {A.OBS_SQL}
SELECT station_id, seq, value FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY time, seq) AS rn
  FROM obs WHERE variable = 'view' AND time >= TIMESTAMP '2024-01-10' AND time < TIMESTAMP '2024-01-21')
WHERE rn <= 3""")
def selection_chain(t):
    s = select.Selection(A.obs(t), "co2", tie=["seq"])
    out = s["view"].sel(time=slice("2024-01-10", "2024-01-20")).isel(slice(0, 3))
    return out.df.select("station_id", "seq", "value")
