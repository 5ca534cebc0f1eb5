"""The driver's tables in the shapes of the data model, with the same views in SQL.

``*_SQL`` constants are common table expressions that mirror the function of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import Tables

GAS_OF = {"view": "co2", "click": "ch4", "purchase": "n2o", "signup": "co"}


def _hundredths():
    """The decimals of the value (0..99): a cheap, evenly spread source of flags and keys."""
    return (F.floor(F.col("value") * 100) % 100).cast("int")


def obs(t: Tables, *more: str) -> DataFrame:
    """Station observations with quality flags taken from the decimals of the value."""
    k = _hundredths()
    return t.events.select(
        F.col("event_id").alias("seq"), F.col("user_id").alias("station_id"),
        F.col("event_type").alias("variable"), F.col("ts").alias("time"), "value", k.alias("k"),
        (F.floor(k / 20) - 1).cast("int").alias("qc"),
        F.element_at(F.array(*[F.lit(c) for c in "UOCX"]), F.floor(k / 25).cast("int") + 1).alias(
            "qc_flag"),
        *more,
    )


OBS_SQL = """obs AS (
  SELECT event_id AS seq, user_id AS station_id, event_type AS variable, ts AS time, value, k,
         CAST(k // 20 - 1 AS INTEGER) AS qc, substr('UOCX', CAST(k // 25 + 1 AS INTEGER), 1) AS qc_flag
  FROM (SELECT *, CAST(CAST(floor(value * 100) AS BIGINT) % 100 AS INTEGER) AS k FROM events))"""


def stations(t: Tables) -> DataFrame:
    """Station dimension: position, intake height and naming of each customer."""
    key = F.col("c_custkey")
    return t.customer.select(
        key.alias("station_id"), F.col("c_name").alias("name"),
        F.upper(F.substring("c_mktsegment", 1, 3)).alias("trigram"),
        (35.0 + (key * 37 % 3500) / 100.0).alias("lat"),
        (-10.0 + (key * 91 % 4000) / 100.0).alias("lon"),
        F.col("c_nationkey").alias("country"), F.col("c_acctbal").alias("altitude"),
        (F.col("c_nationkey") % 4 * 50 + 10).cast("int").alias("height"),
    )


STATIONS_SQL = """stations AS (
  SELECT c_custkey AS station_id, c_name AS name, upper(substr(c_mktsegment, 1, 3)) AS trigram,
         35.0::DOUBLE + (c_custkey * 37 % 3500) / 100.0::DOUBLE AS lat,
         -10.0::DOUBLE + (c_custkey * 91 % 4000) / 100.0::DOUBLE AS lon,
         c_nationkey AS country, c_acctbal AS altitude,
         CAST(c_nationkey % 4 * 50 + 10 AS INTEGER) AS height
  FROM customer)"""


def gas_rows(t: Tables, *more: str) -> DataFrame:
    """Gas rows in mol/mol with the file they come from; other event types carry no gas.

    ``more`` names further columns of the events to keep.
    """
    rows, dim = obs(t, *more), stations(t).select("station_id", "trigram", "height")
    # A stream would send a broadcast dimension through the driver again with every micro-batch.
    o = rows.join(dim.hint("merge") if rows.isStreaming else dim, "station_id")
    gas = F.create_map(*[F.lit(x) for p in GAS_OF.items() for x in p])
    return o.withColumn("gas", F.try_element_at(gas, F.col("variable"))).select(
        "seq", "station_id", "gas", "time", (F.col("value") * 1e-6).alias("value"),
        (F.col("k") * 1e-9).alias("value_std_dev"),
        F.when(F.col("qc") < 0, "mol mol-1").otherwise("ppb").alias("std_unit"),
        "qc_flag", "trigram", "height",
        F.concat(
            "gas", F.lit("_"), F.lower("trigram"),
            F.when(F.col("height") == 10, "_surface-insitu_").otherwise("_tower-insitu_"),
            (F.col("station_id") + 100).cast("string"), F.lit("_allvalid"),
            F.when(F.col("height") == 10, "").otherwise(
                F.concat(F.lit("-"), F.col("height").cast("string"), F.lit("magl"))),
            F.lit(".nc"),
        ).alias("file_name"), *more,
    )


GAS_SQL = f"""{OBS_SQL}, {STATIONS_SQL}, gas_rows AS (
  SELECT seq, station_id, gas, time, value * 1e-6 AS value, k * 1e-9 AS value_std_dev,
         CASE WHEN qc < 0 THEN 'mol mol-1' ELSE 'ppb' END AS std_unit, qc_flag, trigram, height,
         CASE WHEN gas IS NOT NULL THEN gas || '_' || lower(trigram)
           || CASE WHEN height = 10 THEN '_surface-insitu_' ELSE '_tower-insitu_' END
           || (station_id + 100) || '_allvalid'
           || CASE WHEN height = 10 THEN '' ELSE '-' || height || 'magl' END || '.nc' END AS file_name
  FROM (SELECT o.*, s.trigram, s.height,
               CASE o.variable WHEN 'view' THEN 'co2' WHEN 'click' THEN 'ch4'
                    WHEN 'purchase' THEN 'n2o' WHEN 'signup' THEN 'co' END AS gas
        FROM obs o JOIN stations s USING (station_id)))"""


def track(t: Tables) -> DataFrame:
    """Ship and buoy rows: one deployment per user, some at a fixed place."""
    moving = F.col("station_id") % 5 != 0
    drift = F.col("value") / 50.0
    return obs(t).select(
        F.col("station_id").alias("deployment"), "seq", "time", "value", "qc", "variable",
        (F.col("station_id") % 60 - 30 + F.when(moving, drift).otherwise(0.0)).alias("lon"),
        (F.col("station_id") % 40 + F.when(moving, drift / 2).otherwise(0.0)).alias("lat"),
        (F.floor(F.col("k") / 30)).cast("int").alias("lon_qc"),
        (F.floor(F.col("k") / 40)).cast("int").alias("lat_qc"),
    )


TRACK_SQL = f"""{OBS_SQL}, track AS (
  SELECT station_id AS deployment, seq, time, value, qc, variable,
         station_id % 60 - 30 + CASE WHEN station_id % 5 <> 0 THEN value / 50.0::DOUBLE ELSE 0.0::DOUBLE END AS lon,
         station_id % 40 + CASE WHEN station_id % 5 <> 0 THEN value / 50.0::DOUBLE / 2 ELSE 0.0::DOUBLE END AS lat,
         CAST(k // 30 AS INTEGER) AS lon_qc, CAST(k // 40 AS INTEGER) AS lat_qc
  FROM obs)"""


def wide_flux(t: Tables) -> DataFrame:
    """Line items as a wide flux table; zero tax plays the -9999 sentinel."""
    li = t.lineitem

    def masked(col):
        return F.when(F.col("l_tax") == 0, F.lit(-9999.0)).otherwise(col)

    q, p, d, x = (F.col(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    return li.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("site_id"),
        F.col("l_returnflag").alias("product"), F.col("l_shipdate").alias("ts_start"),
        masked(q).alias("NEE_VUT_REF"), (F.round(d * 100) / 2).alias("NEE_VUT_REF_QC"),
        x.alias("NEE_VUT_REF_RANDUNC"), (q - 1).alias("NEE_VUT_16"), (q + 2).alias("NEE_VUT_84"),
        d.alias("NEE_VUT_REF_RANDUNC_METHOD"), q.alias("NEE_CUT_50"),
        masked(p).alias("GPP_NT_VUT_REF"), (q * 2).alias("RECO_DT_CUT_MEAN"),
        (q * 3).alias("RECO_DT_CUT_MEAN_QC"), q.alias("TS_F_MDS_1"), d.alias("TS_F_MDS_1_QC"),
        (q + 5).alias("SWC_F_MDS_2"), q.alias("LE_CORR"), (q - 3).alias("LE_CORR_25"),
        (q + 3).alias("LE_CORR_75"), masked(q).alias("TA_1_10_2"),
        F.col("l_linenumber").cast("double").alias("TA_1_10_2_N"), d.alias("TA_1_10_2_SE"),
        q.alias("CO2_DRY_7"), (q + 1).alias("CO2_DRY_9"), d.alias("CO2_DRY_9_SD"),
        q.alias("G_1"), masked(p).alias("TA_F"), (d * 10).alias("TA_F_QC"),
    )


WIDE_SQL = """wide AS (
  SELECT 'S' || l_suppkey AS site_id, l_returnflag AS product, l_shipdate AS ts_start,
    CASE WHEN l_tax = 0 THEN -9999.0::DOUBLE ELSE l_quantity END AS NEE_VUT_REF,
    round(l_discount * 100) / 2 AS NEE_VUT_REF_QC, l_tax AS NEE_VUT_REF_RANDUNC,
    l_quantity - 1 AS NEE_VUT_16, l_quantity + 2 AS NEE_VUT_84,
    l_discount AS NEE_VUT_REF_RANDUNC_METHOD, l_quantity AS NEE_CUT_50,
    CASE WHEN l_tax = 0 THEN -9999.0::DOUBLE ELSE l_extendedprice END AS GPP_NT_VUT_REF,
    l_quantity * 2 AS RECO_DT_CUT_MEAN, l_quantity * 3 AS RECO_DT_CUT_MEAN_QC,
    l_quantity AS TS_F_MDS_1, l_discount AS TS_F_MDS_1_QC, l_quantity + 5 AS SWC_F_MDS_2,
    l_quantity AS LE_CORR, l_quantity - 3 AS LE_CORR_25, l_quantity + 3 AS LE_CORR_75,
    CASE WHEN l_tax = 0 THEN -9999.0::DOUBLE ELSE l_quantity END AS TA_1_10_2,
    l_linenumber::DOUBLE AS TA_1_10_2_N, l_discount AS TA_1_10_2_SE, l_quantity AS CO2_DRY_7,
    l_quantity + 1 AS CO2_DRY_9, l_discount AS CO2_DRY_9_SD, l_quantity AS G_1,
    CASE WHEN l_tax = 0 THEN -9999.0::DOUBLE ELSE l_extendedprice END AS TA_F,
    l_discount * 10 AS TA_F_QC
  FROM lineitem)"""

WIDE_KEYS = ["site_id", "product", "ts_start"]


def access(t: Tables) -> DataFrame:
    """Request log: clients ask for chunks of arrays; some rows are metadata requests."""
    e = t.events.withColumn("k", _hundredths())
    ip = F.when(
        F.col("user_id") % 7 == 0,
        F.concat(F.lit("2001:db8:"), F.col("user_id").cast("string"), F.lit("::8a2e:370:7334")),
    ).otherwise(F.concat(
        F.lit("10."), F.floor(F.col("user_id") / 250).cast("string"), F.lit("."),
        (F.col("user_id") % 250).cast("string"), F.lit(".42")))
    key = F.when(
        F.col("k") < 5, F.concat(F.lit("S"), (F.col("k") % 4).cast("string"), F.lit("/.zattrs"))
    ).when(F.col("k") < 10, F.lit("119920250401/Temp/0")).when(
        F.col("k") < 15, F.lit("A/B/12/34")
    ).when(F.col("k") < 18, F.lit("12.3")).otherwise(F.concat(
        F.lit("S"), (F.col("k") % 4).cast("string"), F.lit("/"), F.col("event_type"), F.lit("/"),
        (F.col("k") % 3).cast("string"), F.lit("."), (F.col("k") % 2).cast("string")))
    return e.select(
        # Never NULL, so joins need no null filter that would repeat these expressions.
        F.col("event_id").alias("seq"), "ts", F.coalesce(ip, F.lit("")).alias("ip"),
        F.when(F.col("k") < 50, "flux").otherwise("gas").alias("store"),
        F.coalesce(key, F.lit("")).alias("key"),
        F.floor(F.col("value") * 100).cast("bigint").alias("size"),
        F.sha2(F.concat(key, F.lit(":"), (F.col("k") % 10).cast("string")), 256).alias("sha256"),
        F.when(F.col("k") >= 95, "close").otherwise("chunk").alias("event"),
        F.col("user_id"), F.col("k"), F.col("event_type"),
    )


ACCESS_SQL = """access AS (
  SELECT *, sha256(key || ':' || (k % 10)) AS sha256 FROM (
  SELECT event_id AS seq, ts,
    CASE WHEN user_id % 7 = 0 THEN '2001:db8:' || user_id || '::8a2e:370:7334'
         ELSE '10.' || (user_id // 250) || '.' || (user_id % 250) || '.42' END AS ip,
    CASE WHEN k < 50 THEN 'flux' ELSE 'gas' END AS store,
    CASE WHEN k < 5 THEN 'S' || (k % 4) || '/.zattrs' WHEN k < 10 THEN '119920250401/Temp/0'
         WHEN k < 15 THEN 'A/B/12/34' WHEN k < 18 THEN '12.3'
         ELSE 'S' || (k % 4) || '/' || event_type || '/' || (k % 3) || '.' || (k % 2) END AS key,
    CAST(floor(value * 100) AS BIGINT) AS size,
    CASE WHEN k >= 95 THEN 'close' ELSE 'chunk' END AS event, user_id, k, event_type
  FROM (SELECT *, CAST(CAST(floor(value * 100) AS BIGINT) % 100 AS INTEGER) AS k FROM events)))"""

# Sessions of one day of silence: the sample log is thin, so a short timeout would join nothing.
IDLE = 86_400

SESSIONS_SQL = f"""{ACCESS_SQL}, tracked AS (
  SELECT *, CASE WHEN key LIKE '%/%' THEN
           CASE WHEN regexp_extract(key, '^(?:(.*)/)?([^/]*[^0-9./][^/]*)(?:/[0-9.]+)*$', 2) <> ''
                THEN regexp_extract(key, '^(?:(.*)/)?([^/]*[^0-9./][^/]*)(?:/[0-9.]+)*$', 2)
                ELSE split_part(key, '/', 1) END END AS array_name,
         CASE WHEN key LIKE '%/%' THEN
           regexp_extract(key, '^(?:(.*)/)?([^/]*[^0-9./][^/]*)(?:/[0-9.]+)*$', 1) END AS group_path,
         regexp_replace(key, '(/[0-9.]+)+$', '') AS array_path
  FROM access WHERE key NOT LIKE '%/.z%'),
 stepped AS (
  SELECT *, CASE WHEN lag(ts) OVER w IS NULL
                   OR ts - lag(ts) OVER w > INTERVAL {IDLE} SECOND THEN 1 ELSE 0 END AS opens
  FROM tracked WINDOW w AS (PARTITION BY ip, store ORDER BY ts, seq)),
 numbered AS (
  SELECT *, CAST(sum(opens) OVER (PARTITION BY ip, store ORDER BY ts, seq) AS BIGINT) AS session_no
  FROM stepped)"""


def tiles(t: Tables) -> DataFrame:
    """Embeddings as 8 x 8 raster tiles of raw counts; strongly negative cells are nodata."""
    counts = F.transform(
        "embedding",
        lambda x: F.when(x < -0.25, F.lit(-9999)).otherwise(F.floor(x.cast("double") * 20000)).cast(
            "smallint"),
    )
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("vec_id") % 90).cast("int"))
    return t.embeddings.select(
        day.alias("date"), F.floor(F.col("vec_id") / 90).cast("int").alias("tile_row"),
        F.col("label").alias("tile_col"), F.col("vec_id").alias("file"), counts.alias("data"),
    )


TILES_SQL = """tiles AS (
  SELECT DATE '2020-01-01' + CAST(vec_id % 90 AS INTEGER) AS date,
         CAST(vec_id // 90 AS INTEGER) AS tile_row, label AS tile_col, vec_id AS file,
         list_transform(embedding, lambda x: CASE WHEN x < -0.25::FLOAT THEN -9999
           ELSE CAST(floor(x::DOUBLE * 20000) AS INTEGER) END) AS data
  FROM embeddings)"""


def span(t: Tables) -> tuple[str, str, int]:
    """First and last hour of the days with observations, and the number of days: one row of the data.

    A table without any has an empty grid, from a day to the hour before it.
    """
    day = F.col("ts").cast("date")
    first, last = t.events.agg(F.min(day), F.max(day)).first()
    if first is None:
        return "1970-01-01 00:00:00", "1969-12-31 23:00:00", 0
    return f"{first} 00:00:00", f"{last} 23:00:00", (last - first).days + 1


def hourly(t: Tables) -> DataFrame:
    """Gap-ridden hourly series per variable: hour floor, quality mask, first value, full grid.

    The grid runs over all days of the data, so no row lies outside of it.
    """
    from ..functions import clean
    from ..operators import joins

    o = obs(t).filter("time IS NOT NULL").withColumn("hour", clean.hour_floor("time")).withColumn(
        "value", clean.mask_set("value", "qc_flag", ["U", "O"])
    )
    first = joins.first_row_wins(o, ["variable", "hour"], ["time", "seq"], ["value"])
    # Variables are a short vocabulary of the data.
    names = o.select("variable").distinct()
    start, end, days = span(t)
    if not days:
        return joins.reindex(names.select("variable", F.lit(start).cast("timestamp_ntz").alias("hour"))
                             .filter("false"), first, ["variable", "hour"])
    grid = joins.regular_grid(names, "variable", start, end, "INTERVAL 1 HOUR", "hour")
    return joins.reindex(grid, first, ["variable", "hour"])


# Parts of the span, for SQL that follows HOURLY_SQL.
FIRST_SQL, DAYS_SQL = "(SELECT first FROM span)", "(SELECT days FROM span)"

HOURLY_SQL = f"""{OBS_SQL}, span AS (
  SELECT date_trunc('day', min(time))::TIMESTAMP AS first, date_trunc('day', max(time))::TIMESTAMP + INTERVAL 23 HOUR AS last,
    date_diff('day', min(time), max(time)) + 1 AS days FROM obs), hourly AS (
  SELECT g.variable, g.hour, f.value
  FROM (SELECT variable, unnest(generate_series((SELECT first FROM span), (SELECT last FROM span),
               INTERVAL 1 HOUR)) AS hour FROM (SELECT DISTINCT variable FROM obs WHERE time IS NOT NULL)) g
  LEFT JOIN (SELECT variable, date_trunc('hour', time) AS hour,
                    CASE WHEN qc_flag IN ('U', 'O') THEN value END AS value
             FROM obs QUALIFY row_number() OVER (
               PARTITION BY variable, date_trunc('hour', time) ORDER BY time, seq) = 1) f
  USING (variable, hour))"""


def daily(t: Tables) -> DataFrame:
    from ..operators import aggregates

    return aggregates.slot_means(hourly(t), ["variable"], "hour", "value", "DAY", "day").select(
        "variable", "day", F.col("mean_value").alias("value")
    )


DAILY_SQL = f"""{HOURLY_SQL}, daily AS (
  SELECT variable, date_trunc('day', hour)::TIMESTAMP AS day, avg(value) AS value
  FROM hourly GROUP BY ALL)"""
