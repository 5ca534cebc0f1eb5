"""Scalar cleaning, naming and masking over whole tables (B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean, names
from ..operators import joins, reshape
from . import adapters as A
from .registry import query


@query("clean_values", f"""WITH {A.WIDE_SQL}
SELECT product, count(*) AS n_rows, count(CASE WHEN "NEE_VUT_REF" <> -9999 THEN 1 END) AS n_values,
       avg(nullif("NEE_VUT_REF", -9999)) AS mean_value FROM wide GROUP BY product""")
def clean_values(t):
    w = A.wide_flux(t)
    v = clean.clean_value("NEE_VUT_REF")
    return w.groupBy("product").agg(
        F.count("*").alias("n_rows"), F.count(v).alias("n_values"), F.avg(v).alias("mean_value")
    )


@query("qc_normalise", f"""WITH {A.WIDE_SQL}
SELECT "NEE_VUT_REF_QC" AS raw_qc,
       CAST(greatest(0, least(3, round_even("NEE_VUT_REF_QC", 0))) AS INTEGER) AS qc,
       count(*) AS n FROM wide GROUP BY ALL""")
def qc_normalise(t):
    return A.wide_flux(t).groupBy(
        F.col("NEE_VUT_REF_QC").alias("raw_qc"),
        clean.clean_qc("NEE_VUT_REF_QC").cast("int").alias("qc"),
    ).agg(F.count("*").alias("n"))


_STORAGE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax"]
_STORAGE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column, count({c}) AS n_values, 0 AS n_text, "
    f"bool_and({c} = floor({c})) AS integral, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max "
    f"FROM lineitem" for c in _STORAGE
)


@query("narrow_integers", f"""WITH p AS ({_STORAGE_SQL})
SELECT "column", n_values, integral, CASE WHEN NOT integral THEN 'float'
  WHEN min >= -128 AND max <= 127 THEN 'tinyint' WHEN min >= -32768 AND max <= 32767 THEN 'smallint'
  WHEN max <= 2147483647 THEN 'int' ELSE 'bigint' END AS storage FROM p""")
def narrow_integers(t):
    p = reshape.storage_type(reshape.column_profile(t.lineitem, _STORAGE))
    return p.select("column", "n_values", "integral", "storage")


@query("narrow_counts", f"""WITH p AS ({_STORAGE_SQL})
SELECT "column", CASE WHEN max <= 127 THEN 'tinyint' WHEN max <= 32767 THEN 'smallint'
  ELSE 'int' END AS storage FROM p WHERE "column" IN ('l_linenumber', 'l_quantity', 'l_partkey')""")
def narrow_counts(t):
    cols = ["l_linenumber", "l_quantity", "l_partkey"]
    return reshape.storage_type(reshape.column_profile(t.lineitem, cols), "count").select(
        "column", "storage"
    )


@query("narrow_flags", f"""WITH p AS ({_STORAGE_SQL})
SELECT "column", CASE WHEN NOT integral THEN 'float' WHEN max <= 254 THEN 'smallint'
  WHEN max <= 2147483647 THEN 'int' ELSE 'bigint' END AS storage FROM p
WHERE "column" IN ('l_linenumber', 'l_discount', 'l_orderkey')""")
def narrow_flags(t):
    cols = ["l_linenumber", "l_discount", "l_orderkey"]
    return reshape.storage_type(reshape.column_profile(t.lineitem, cols), "qc").select(
        "column", "storage"
    )


@query("text_columns", """
SELECT 'o_orderpriority' AS "column",
       count(CASE WHEN o_orderpriority IS NOT NULL AND try_cast(o_orderpriority AS DOUBLE) IS NULL THEN 1 END) AS n_text,
       'text' AS storage FROM orders
UNION ALL SELECT 'o_totalprice', 0, 'float' FROM orders HAVING count(*) > 0
UNION ALL SELECT 'o_orderstatus',
       count(CASE WHEN o_orderstatus IS NOT NULL AND try_cast(o_orderstatus AS DOUBLE) IS NULL THEN 1 END),
       'text' FROM orders""")
def text_columns(t):
    cols = ["o_orderpriority", "o_totalprice", "o_orderstatus"]
    return reshape.storage_type(reshape.column_profile(t.orders, cols)).select(
        "column", "n_text", "storage"
    )


@query("parse_timestamps", """
SELECT CASE WHEN o_orderkey % 4 = 0 THEN date_trunc('minute', o_orderdate + to_minutes(o_orderkey % 1440))
            WHEN o_orderkey % 4 = 1 THEN date_trunc('day', o_orderdate)
            WHEN o_orderkey % 4 = 2 THEN date_trunc('month', o_orderdate)
            ELSE date_trunc('year', o_orderdate) END::TIMESTAMP AS ts, count(*) AS n
FROM orders GROUP BY 1""")
def parse_timestamps(t):
    o = t.orders.withColumn(
        "stamp", F.timestamp_add("MINUTE", F.col("o_orderkey") % 1440, F.col("o_orderdate"))
    )
    kind = F.col("o_orderkey") % 4
    text = (
        F.when(kind == 0, F.date_format("stamp", "yyyyMMddHHmm"))
        .when(kind == 1, F.date_format("o_orderdate", "yyyyMMdd"))
        .when(kind == 2, F.date_format("o_orderdate", "yyyyMM"))
        .otherwise(F.date_format("o_orderdate", "yyyy"))
    )
    return o.groupBy(clean.parse_flux_time(text).alias("ts")).agg(F.count("*").alias("n"))


@query("period_ends", """
SELECT freq, period_end, count(*) AS n FROM (
  SELECT freq, CASE freq WHEN 'HH' THEN o_orderdate + INTERVAL 30 MINUTE
    WHEN 'DD' THEN o_orderdate + INTERVAL 1 DAY WHEN 'WW' THEN o_orderdate + INTERVAL 7 DAY
    WHEN 'MM' THEN o_orderdate + INTERVAL 1 MONTH ELSE o_orderdate + INTERVAL 1 YEAR END AS period_end
  FROM (SELECT *, CASE o_orderstatus WHEN 'O' THEN 'MM' WHEN 'F' THEN 'YY' ELSE
          CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'HH' WHEN '2' THEN 'DD' ELSE 'WW' END END AS freq
        FROM orders)) GROUP BY ALL""")
def period_ends(t):
    first = F.substring("o_orderpriority", 1, 1)
    freq = (
        F.when(F.col("o_orderstatus") == "O", "MM").when(F.col("o_orderstatus") == "F", "YY")
        .when(first == "1", "HH").when(first == "2", "DD").otherwise("WW")
    )
    o = t.orders.withColumn("freq", freq)
    return o.groupBy("freq", clean.period_end("o_orderdate", "freq").alias("period_end")).agg(
        F.count("*").alias("n")
    )


@query("cf_times", """
SELECT event_id, date_diff('microsecond', TIMESTAMP '2024-01-01', ts) / 60000000.0::DOUBLE AS minutes,
       CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS days, ts AS decoded
FROM events""")
def cf_times(t):
    minutes = clean.cf_minutes("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    back = clean.cf_decode(minutes, "minutes", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return t.events.select(
        "event_id", minutes.alias("minutes"), clean.cf_days("ts").alias("days"),
        back.alias("decoded"),
    )


# File names put together from the tables, as landed files would carry them.
_NAME_SQL = """names AS (
  SELECT l_orderkey, l_suppkey, l_linenumber, 'ICOSETC_SE-' || l_suppkey || '_'
    || CASE l_returnflag WHEN 'A' THEN 'FLUXNET' WHEN 'N' THEN 'FLUXES' ELSE 'METEOSENS' END
    || CASE l_linestatus WHEN 'O' THEN '_HH' ELSE '_DD' END
    || CASE WHEN l_linenumber > 3 THEN '_INTERIM' ELSE '' END || '_L2.csv' AS path FROM lineitem)"""


def _flux_names(t):
    token = (
        F.when(F.col("l_returnflag") == "A", "FLUXNET").when(F.col("l_returnflag") == "N", "FLUXES")
        .otherwise("METEOSENS")
    )
    return t.lineitem.select("l_orderkey", "l_suppkey", "l_linenumber", F.concat(
        F.lit("ICOSETC_SE-"), F.col("l_suppkey").cast("string"), F.lit("_"), token,
        F.when(F.col("l_linestatus") == "O", "_HH").otherwise("_DD"),
        F.when(F.col("l_linenumber") > 3, "_INTERIM").otherwise(""), F.lit("_L2.csv"),
    ).alias("path"))


@query("file_frequency", f"""WITH {_NAME_SQL}
SELECT regexp_extract(path, '_(HH|DD)_', 1) AS freq, count(*) AS n FROM names GROUP BY 1""")
def file_frequency(t):
    return _flux_names(t).groupBy(names.freq_from_name("path").alias("freq")).agg(
        F.count("*").alias("n")
    )


@query("file_names", f"""WITH {_NAME_SQL}
SELECT regexp_extract(path, '^ICOSETC_([^_]+)_', 1) AS site_id,
       regexp_extract(path, '^ICOSETC_[^_]+_(.+)[.]csv$', 1) AS product,
       lower(regexp_replace(regexp_extract(path, '^ICOSETC_[^_]+_(.+)[.]csv$', 1), '_(INTERIM|L[0-9]).*', '')) AS group_name,
       CASE WHEN path LIKE '%FLUXNET%' THEN 0 WHEN path LIKE '%FLUXES%' THEN 1 ELSE 2 END AS priority,
       count(*) AS n FROM names GROUP BY ALL""")
def file_names(t):
    parsed = names.parse_flux_name("path")
    return _flux_names(t).groupBy(
        parsed["site_id"].alias("site_id"), parsed["product"].alias("product"),
        names.group_name(parsed["product"]).alias("group_name"),
        names.product_priority("path").alias("priority"),
    ).agg(F.count("*").alias("n"))


@query("sibling_files", f"""WITH {_NAME_SQL}
SELECT regexp_replace(replace(path, '.csv', ''), '_(HH|DD)_', '_*_') AS series,
       count(DISTINCT regexp_extract(path, '_(HH|DD)_', 1)) AS n_freqs, count(*) AS n
FROM names GROUP BY 1""")
def sibling_files(t):
    from ..sources import flux_csv

    return flux_csv.sibling_files(_flux_names(t), "path").groupBy("series").agg(
        F.count_distinct("freq").alias("n_freqs"), F.count("*").alias("n")
    )


@query("archive_member_filter", f"""WITH {_NAME_SQL}
SELECT 'archive/' || path AS member, count(*) AS n FROM names
WHERE path LIKE '%FLUXNET%' GROUP BY 1""")
def archive_member_filter(t):
    from ..sources import flux_csv

    # FLUXES_HH and METEOSENS_HH are no product names, so only the FLUXNET files are wanted.
    n = _flux_names(t).select(F.concat(F.lit("archive/"), "path").alias("member"))
    return n.filter(flux_csv.needed_member("member")).groupBy("member").agg(
        F.count("*").alias("n")
    )


@query("gas_file_names", f"""WITH {A.GAS_SQL}
SELECT gas, trigram AS site, CASE WHEN height = 10 THEN 'surface-insitu' ELSE 'tower-insitu' END AS kind,
       CAST(station_id + 100 AS INTEGER) AS dataset_num, CASE WHEN height <> 10 THEN height END AS height,
       trigram || CASE WHEN height = 10 THEN 0 ELSE height END AS gas_station, count(*) AS n
FROM gas_rows WHERE gas IS NOT NULL GROUP BY ALL""")
def gas_file_names(t):
    g = A.gas_rows(t).filter("gas IS NOT NULL")
    p = names.parse_gas_name("file_name")
    return g.groupBy(
        p["gas"].alias("gas"), F.upper(p["trigram"]).alias("site"), p["kind"].alias("kind"),
        p["dataset_num"].alias("dataset_num"), p["height"].alias("height"),
        p["station_id"].alias("gas_station"),
    ).agg(F.count("*").alias("n"))


@query("cruise_names", """
SELECT c_mktsegment || strftime(DATE '2020-01-01' + CAST(c_nationkey AS INTEGER), '%Y%m%d') AS deployment,
       c_mktsegment AS platform, count(*) AS n FROM customer GROUP BY ALL""")
def cruise_names(t):
    day = F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), F.col("c_nationkey")), "yyyyMMdd")
    path = F.concat(F.lit("s3/landing/"), "c_mktsegment", day, F.lit(".csv"))
    return t.customer.groupBy(
        names.deployment_id(path).alias("deployment"), names.platform_code(path).alias("platform")
    ).agg(F.count("*").alias("n"))


@query("label_units", """
SELECT p_type || ' [' || p_brand || ']' AS label,
       CASE WHEN p_size % 3 = 0 THEN 'cat' ELSE p_brand END AS unit, count(*) AS n
FROM part GROUP BY ALL""")
def label_units(t):
    label = F.concat("p_type", F.lit(" ["), "p_brand", F.lit("]"))
    catalogue = F.when(F.col("p_size") % 3 == 0, "cat")
    return t.part.groupBy(
        label.alias("label"), names.unit_of_label(label, catalogue).alias("unit")
    ).agg(F.count("*").alias("n"))


_KINDS = ["Water temperature", "Practical salinity", "CO2 partial pressure (water)",
          "CO2 fugacity (air)", "Atmospheric pressure", "Longitude", "Wind"]


@query("standard_names", """
SELECT kind, CASE kind WHEN 'Water temperature' THEN 'sea_water_temperature'
  WHEN 'Practical salinity' THEN 'sea_water_practical_salinity'
  WHEN 'CO2 partial pressure (water)' THEN 'surface_partial_pressure_of_carbon_dioxide_in_sea_water'
  WHEN 'CO2 fugacity (air)' THEN 'fugacity_of_carbon_dioxide_in_air'
  WHEN 'Atmospheric pressure' THEN 'air_pressure' WHEN 'Longitude' THEN 'longitude' ELSE '' END AS standard_name,
  count(*) AS n FROM (SELECT ['Water temperature', 'Practical salinity', 'CO2 partial pressure (water)',
    'CO2 fugacity (air)', 'Atmospheric pressure', 'Longitude', 'Wind'][CAST(p_partkey % 7 + 1 AS INTEGER)] AS kind
  FROM part) GROUP BY ALL""")
def standard_names(t):
    kind = F.element_at(
        F.array(*[F.lit(k) for k in _KINDS]), (F.col("p_partkey") % 7 + 1).cast("int")
    )
    p = t.part.withColumn("kind", kind)
    return p.groupBy("kind", names.standard_name("kind").alias("standard_name")).agg(
        F.count("*").alias("n")
    )


_VARIABLES = ["NEE_VUT_REF", "TA_1_10_2", "SW_IN_F", "LE_F_MDS", "CO2_DRY_7", "TA_F_QC", "FETCH_90",
              "ZZ_TOP"]


@query("variable_metadata", """
SELECT name, root, suffix, units, standard_name, long_name, count(*) AS n FROM (
  SELECT ['NEE_VUT_REF', 'TA_1_10_2', 'SW_IN_F', 'LE_F_MDS', 'CO2_DRY_7', 'TA_F_QC', 'FETCH_90',
          'ZZ_TOP'][CAST(p_partkey % 8 + 1 AS INTEGER)] AS name FROM part)
JOIN (VALUES
  ('NEE_VUT_REF', 'NEE', 'VUT_REF', 'umol m-2 s-1', NULL, 'Net Ecosystem CO2 Exchange (VUT reference partitioning)'),
  ('TA_1_10_2', 'TA', '', 'degC', 'air_temperature', 'Air Temperature'),
  ('SW_IN_F', 'SW_IN', 'F', 'W m-2', NULL, 'Incoming Shortwave Radiation (gap-filled)'),
  ('LE_F_MDS', 'LE', 'F_MDS', 'W m-2', NULL, 'Latent Heat Flux (gap-filled by Marginal Distribution Sampling)'),
  ('CO2_DRY_7', 'CO2', 'DRY', 'umol mol-1', NULL, 'CO2 Mole Fraction (DRY)'),
  ('TA_F_QC', 'TA', 'F_QC', 'degC', NULL, 'Quality Control Flag for Air Temperature (gap-filled)'),
  ('FETCH_90', 'FETCH', '', '1', NULL, 'Fetch'),
  ('ZZ_TOP', 'ZZ_TOP', '', '1', NULL, 'Zz Top')) AS m(name, root, suffix, units, standard_name, long_name)
USING (name) GROUP BY ALL""")
def variable_metadata(t):
    name = F.element_at(
        F.array(*[F.lit(k) for k in _VARIABLES]), (F.col("p_partkey") % 8 + 1).cast("int")
    )
    counted = t.part.groupBy(name.alias("name")).agg(F.count("*").alias("n"))
    return counted.select("name", names.describe_variable("name").alias("d"), "n").select(
        "name", "d.*", "n"
    )


@query("rescale_gas", f"""WITH {A.GAS_SQL}
SELECT gas, round(avg(value * f), 9) AS mean_value, round(avg(CASE WHEN std_unit = 'mol mol-1' THEN value_std_dev * f ELSE value_std_dev END), 9) AS mean_std,
       CASE gas WHEN 'co2' THEN 'ppm' ELSE 'ppb' END AS unit
FROM (SELECT *, CASE gas WHEN 'co2' THEN 1e6 ELSE 1e9 END AS f FROM gas_rows WHERE gas IS NOT NULL)
GROUP BY gas""")
def rescale_gas(t):
    g = A.gas_rows(t).filter("gas IS NOT NULL")
    return g.groupBy("gas", clean.gas_unit("gas").alias("unit")).agg(
        F.round(F.avg(clean.rescale_gas("value", "gas")), 9).alias("mean_value"),
        F.round(F.avg(clean.rescale_gas("value_std_dev", "gas", "std_unit")), 9).alias("mean_std"),
    )


@query("mask_flag_range", f"""WITH {A.TRACK_SQL}
SELECT deployment, count(*) AS n_rows, count(v) AS n_good, round(avg(v), 6) AS mean_value FROM (
  SELECT *, CASE WHEN qc BETWEEN 0 AND 2 AND lon_qc BETWEEN 0 AND 2 AND lat_qc BETWEEN 0 AND 2
            THEN value END AS v FROM track) GROUP BY deployment""")
def mask_flag_range(t):
    v = clean.mask_range("value", "qc", "lon_qc", "lat_qc")
    return A.track(t).groupBy("deployment").agg(
        F.count("*").alias("n_rows"), F.count(v).alias("n_good"),
        F.round(F.avg(v), 6).alias("mean_value"),
    )


@query("mask_flag_set", f"""WITH {A.OBS_SQL}
SELECT variable, qc_flag, count(CASE WHEN qc_flag IN ('U', 'O') THEN value END) AS n_kept, count(*) AS n_rows
FROM obs GROUP BY ALL""")
def mask_flag_set(t):
    kept = clean.mask_set("value", "qc_flag", ["U", "O"])
    return A.obs(t).groupBy("variable", "qc_flag").agg(
        F.count(kept).alias("n_kept"), F.count("*").alias("n_rows")
    )


@query("clip_unit_interval", """
SELECT vec_id, CASE WHEN embedding[1] IS NOT NULL THEN greatest(0, least(1, embedding[1]::DOUBLE * 5 + 0.5)) END AS clipped
FROM embeddings""")
def clip_unit_interval(t):
    x = F.get("embedding", 0).cast("double") * 5 + 0.5
    return t.embeddings.select("vec_id", clean.clip01(x).alias("clipped"))


@query("anonymise_ip", f"""WITH {A.ACCESS_SQL}
SELECT CASE WHEN ip LIKE '%:%' THEN array_to_string(string_split(ip, ':')[1:3], ':') || '::/48'
            ELSE array_to_string(string_split(ip, '.')[1:3], '.') || '.0/24' END AS network, count(*) AS n
FROM access GROUP BY 1""")
def anonymise_ip(t):
    return A.access(t).groupBy(names.anonymise_ip("ip").alias("network")).agg(
        F.count("*").alias("n")
    )


@query("chunk_keys", f"""WITH {A.SESSIONS_SQL}
SELECT key, array_name, group_path, array_path, count(*) AS n FROM tracked GROUP BY ALL""")
def chunk_keys(t):
    from ..operators import sessions

    c = sessions.tracked(A.access(t))
    return c.groupBy(
        "key", F.col("array").alias("array_name"), F.col("group").alias("group_path"), "array_path"
    ).agg(F.count("*").alias("n"))


@query("attribute_fallbacks", """
SELECT o_orderkey, coalesce(try_cast(substr(o_orderpriority, 1, 1) || o_orderstatus AS DOUBLE), try_cast(substr(o_orderpriority, 1, 1) AS DOUBLE)) AS number,
       CASE WHEN o_orderstatus = 'O' THEN o_orderpriority ELSE o_orderstatus END AS text
FROM orders""")
def attribute_fallbacks(t):
    first = F.substring("o_orderpriority", 1, 1)
    blank = F.when(F.col("o_orderstatus") == "O", "").otherwise(F.col("o_orderstatus"))
    return t.orders.select(
        "o_orderkey",
        clean.first_number(F.concat(first, "o_orderstatus"), first).alias("number"),
        clean.first_text(blank, "o_orderpriority").alias("text"),
    )


@query("pid_addresses", """
SELECT CASE WHEN p_size % 2 = 0 THEN 'https://doi.org/' || p_brand WHEN p_size % 5 = 0 THEN ''
            ELSE 'https://hdl.handle.net/11676/' || p_brand END AS url, count(*) AS n FROM part GROUP BY 1""")
def pid_addresses(t):
    pid = (
        F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("https://doi.org/"), "p_brand"))
        .when(F.col("p_size") % 5 == 0, "").otherwise(F.concat(F.lit("11676/"), "p_brand"))
    )
    return t.part.groupBy(names.pid_url(pid).alias("url")).agg(F.count("*").alias("n"))


@query("uncertainty", f"""WITH {A.WIDE_SQL}
SELECT site_id, round(avg(sqrt("NEE_VUT_REF_RANDUNC" ** 2 + (("NEE_VUT_84" - "NEE_VUT_16") / 2) ** 2)), 8) AS joint,
  round(min("NEE_VUT_16" - "NEE_VUT_REF_RANDUNC"), 6) AS low, round(max("NEE_VUT_16" + "NEE_VUT_REF_RANDUNC"), 6) AS high
FROM wide GROUP BY site_id""")
def uncertainty(t):
    low, high = clean.envelope("NEE_VUT_16", "NEE_VUT_REF_RANDUNC")
    joint = clean.joint_uncertainty("NEE_VUT_REF_RANDUNC", "NEE_VUT_16", "NEE_VUT_84")
    return A.wide_flux(t).groupBy("site_id").agg(
        F.round(F.avg(joint), 8).alias("joint"), F.round(F.min(low), 6).alias("low"),
        F.round(F.max(high), 6).alias("high"),
    )


@query("calendar_fields", f"""WITH {A.OBS_SQL}
SELECT date_trunc('hour', time)::TIMESTAMP AS hour, extract(hour FROM time) >= 18 OR extract(hour FROM time) < 6 AS night,
  CASE WHEN month(time) IN (12, 1, 2) THEN 'DJF' WHEN month(time) <= 5 THEN 'MAM' WHEN month(time) <= 8 THEN 'JJA' ELSE 'SON' END AS season,
  CAST(dayofyear(time) AS INTEGER) AS doy, count(*) AS n FROM obs GROUP BY ALL""")
def calendar_fields(t):
    return A.obs(t).groupBy(
        clean.hour_floor("time").alias("hour"), clean.is_night("time").alias("night"),
        clean.season("time").alias("season"), F.dayofyear("time").alias("doy"),
    ).agg(F.count("*").alias("n"))


@query("zone_labels", """
SELECT CASE WHEN n_nationkey - 11 < 0 THEN 'UTC-' ELSE 'UTC+' END || lpad(CAST(abs(n_nationkey - 11) AS VARCHAR), 2, '0') || ':00' AS zone, n_name
FROM nation""")
def zone_labels(t):
    return t.nation.select(names.zone_label(F.col("n_nationkey") - 11).alias("zone"), "n_name")


@query("preferred_variable", f"""WITH {A.WIDE_SQL}
SELECT site_id, ts_start, round(avg(coalesce(nullif("TA_F", -9999), "LE_CORR")), 6) AS best FROM wide GROUP BY ALL""")
def preferred_variable(t):
    best = F.coalesce(clean.clean_value("TA_F"), clean.clean_value("LE_CORR"))
    return A.wide_flux(t).groupBy("site_id", "ts_start").agg(F.round(F.avg(best), 6).alias("best"))


@query("product_descriptions", f"""WITH {_NAME_SQL}, dim AS (
  SELECT CASE n_nationkey WHEN 0 THEN 'FLUXNET' WHEN 1 THEN 'FLUXES' ELSE 'METEOSENS' END AS token, n_name AS label
  FROM nation WHERE n_nationkey < 3)
SELECT token AS product_token, label, count(*) AS n FROM names JOIN dim
  ON token = CASE WHEN path LIKE '%FLUXNET%' THEN 'FLUXNET' WHEN path LIKE '%FLUXES%' THEN 'FLUXES' ELSE 'METEOSENS' END
GROUP BY ALL""")
def product_descriptions(t):
    token = F.element_at(
        F.array(F.lit("FLUXNET"), F.lit("FLUXES"), F.lit("METEOSENS")), F.col("n_nationkey") + 1
    )
    dim = t.nation.filter("n_nationkey < 3").select(
        token.alias("product_token"), F.col("n_name").alias("label")
    )
    return joins.product_metadata(_flux_names(t), dim, "path").groupBy(
        "product_token", "label"
    ).agg(F.count("*").alias("n"))


@query("export_fill_values", f"""WITH {A.WIDE_SQL}
SELECT product, sum(CASE WHEN "TA_F" = -9999 THEN 1 ELSE 0 END)::BIGINT AS n_filled,
       max(CASE WHEN "TA_F" = -9999 THEN 9.96921e36 ELSE "TA_F" END) AS top FROM wide GROUP BY product""")
def export_fill_values(t):
    w = A.wide_flux(t).withColumn("v", clean.clean_value("TA_F"))
    filled = clean.export_fill("v", "float")
    return w.groupBy("product").agg(
        F.count_if(F.col("v").isNull()).alias("n_filled"), F.max(filled).alias("top")
    )


@query("drop_redundant_columns", f"""WITH {A.GAS_SQL}
SELECT gas, count(*) AS n, round(avg(value * 1e6), 6) AS mean_value FROM gas_rows GROUP BY gas""")
def drop_redundant_columns(t):
    from .. import schema as S

    g = A.gas_rows(t).withColumns({"time_decimal": F.lit(0.0), "obs_num": F.col("seq")})
    return g.drop(*S.REDUNDANT_TIME_COLUMNS).groupBy("gas").agg(
        F.count("*").alias("n"), F.round(F.avg(F.col("value") * 1e6), 6).alias("mean_value")
    )


@query("infer_frequency", f"""WITH {A.OBS_SQL}, firsts AS (
  SELECT station_id, time, row_number() OVER (PARTITION BY station_id ORDER BY time) AS rn FROM obs)
SELECT a.station_id, CASE WHEN b.time IS NULL THEN 'HH' WHEN m <= 60 THEN 'HH' WHEN m <= 1441 THEN 'DD'
  WHEN m <= 10081 THEN 'WW' WHEN m <= 44641 THEN 'MM' ELSE 'YY' END AS freq
FROM (SELECT * FROM firsts WHERE rn = 1) a LEFT JOIN (SELECT * FROM firsts WHERE rn = 2) b USING (station_id),
LATERAL (SELECT floor(date_diff('microsecond', a.time, b.time) / 60000000) AS m)""")
def infer_frequency(t):
    from ..sources import flux_csv

    return flux_csv.infer_frequency(A.obs(t), "station_id", "time")


