"""Catalogue, provenance, documents, labels and rasters (A, J, B36-B38, H3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names, raster
from ..operators import aggregates, catalog, joins
from ..session import shared_dir
from ..sources import documents, ocean_csv
from ..sources import raster as raster_source
from ..sources.versions import Store
from . import adapters as A
from .registry import query


def _events(t):
    """Ingest events of gas files, first event of a station creates it."""
    g = A.gas_rows(t).filter("gas IS NOT NULL")
    rows = g.select(
        F.col("station_id").cast("string").alias("station"), F.col("time").alias("timestamp"),
        F.col("file_name").alias("file"), "gas", F.lit("https://doi.org/10.1/x").alias("source_doi"),
        F.lit("c").alias("citation"),
    )
    return catalog.provenance_events(rows, "station")


_EVENTS_SQL = f"""{A.GAS_SQL}, ev AS (
  SELECT station_id::VARCHAR AS entity, time AS timestamp, file_name AS file, gas,
    CASE WHEN row_number() OVER (PARTITION BY station_id ORDER BY time, file_name) = 1 THEN 'create' ELSE 'update' END AS action
  FROM gas_rows WHERE gas IS NOT NULL)"""


@query("provenance_events", f"""WITH {_EVENTS_SQL} SELECT entity, action, timestamp, file, gas FROM ev""")
def provenance_events(t):
    return _events(t).select("entity", "action", "timestamp", "file", "gas")


@query("provenance_state", f"""WITH {_EVENTS_SQL}
SELECT entity, min(timestamp) AS created, max(timestamp) AS last_updated, count(*) AS n_events,
  arg_max(action, (timestamp, file)) AS last_action, arg_max(file, (timestamp, file)) AS last_file FROM ev GROUP BY entity""")
def provenance_state(t):
    return catalog.provenance_state(_events(t)).select(
        "entity", "created", "last_updated", "n_events", "last_action", "last_file"
    )


@query("station_listing", f"""WITH {_EVENTS_SQL}
SELECT entity, min(timestamp) AS created, max(timestamp) AS last_updated, count(*) AS n_events, count(*) AS n_rows,
  array_to_string(list_filter(['co2','ch4','n2o','co'], lambda g: list_contains(list(gas), g)), ',') AS gases FROM ev GROUP BY entity""")
def station_listing(t):
    counts = A.gas_rows(t).filter("gas IS NOT NULL").groupBy("station_id", "gas").agg(
        F.count("*").alias("n_rows")
    )
    rows = catalog.listing(
        _events(t), counts.withColumn("station_id", F.col("station_id").cast("string")),
        "station_id",
    )
    return rows.withColumn("gases", F.array_join("gases", ","))


@query("station_info", f"""WITH {_EVENTS_SQL}
SELECT 'attribute' AS section, name, text FROM (SELECT unnest(['name', 'trigram', 'country']) AS name, unnest([name, trigram, country::VARCHAR]) AS text FROM stations WHERE station_id = 7)
UNION ALL SELECT 'samples', gas, count(*)::VARCHAR FROM gas_rows WHERE station_id = 7 AND gas IS NOT NULL GROUP BY gas
UNION ALL SELECT 'history', strftime(date_trunc('second', timestamp), '%Y-%m-%d %H:%M:%S'), action FROM ev WHERE entity = '7'""")
def station_info(t):
    dim = A.stations(t).select(
        F.col("station_id").cast("string").alias("station"), "name", "trigram", "country"
    )
    counts = A.gas_rows(t).filter("gas IS NOT NULL").groupBy(
        F.col("station_id").cast("string").alias("station"), "gas"
    ).agg(F.count("*").alias("n_rows"))
    events = _events(t).withColumn("timestamp", F.date_trunc("SECOND", "timestamp"))
    return catalog.station_info("7", dim, counts, events, "station")


@query("removed_stations", f"""WITH {A.OBS_SQL}
SELECT station_id, count(*) AS n FROM obs WHERE station_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY station_id""")
def removed_stations(t):
    """A store of observations from which stations are removed, one commit row each."""
    store = Store(shared_dir(t.spark, "observations"), "station_id", ["station_id"], ["time"])
    store.append(A.obs(t).withColumn("source_file", F.col("variable")))
    store.remove(t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("station_id")))
    return store.read(t.spark).groupBy("station_id").agg(F.count("*").alias("n"))


def _attributes(t, old: bool):
    """Attribute rows of two ingests of each station: gas-prefixed and general names."""
    s = A.stations(t)
    station = F.col("station_id")
    cells = {
        "lat": F.col("lat"), "co2_height": F.col("height") + (0 if old else 1),
        "site_name": F.when(station % 3 != 0, F.col("name")) if old else F.upper("name"),
        "ch4_country": F.when(station % 2 == 0, F.col("country")) if old else
        F.when(station % 5 == 0, F.col("country") + 100),
    }
    items = F.array(*[
        F.struct(F.lit(k).alias("name"), v.cast("string").alias("text"))
        for k, v in cells.items() if k != "lat"
    ])
    return s.select("station_id", F.explode(items).alias("i")).select("station_id", "i.*").filter(
        "text IS NOT NULL"
    )


@query("merge_attributes", f"""WITH {A.STATIONS_SQL}
SELECT station_id, 'co2_height' AS name, (height + 1)::VARCHAR AS text FROM stations
UNION ALL SELECT station_id, 'site_name', CASE WHEN station_id % 3 <> 0 THEN name ELSE upper(name) END FROM stations
UNION ALL SELECT station_id, 'ch4_country', CASE WHEN station_id % 5 = 0 THEN country + 100 ELSE country END::VARCHAR FROM stations WHERE station_id % 5 = 0 OR station_id % 2 = 0""")
def merge_attributes(t):
    return catalog.merge_attributes(_attributes(t, True), _attributes(t, False), "station_id")


@query("backfill_citation", """
SELECT outcome, count(*) AS n, count(citation) AS n_citations FROM (
  SELECT CASE WHEN n_name IS NULL OR n_name LIKE '%7' THEN 'missing' WHEN s_acctbal < 3000 THEN 'patched' ELSE 'skipped' END AS outcome,
    CASE WHEN s_acctbal < 3000 THEN CASE WHEN n_name LIKE '%7' THEN NULL ELSE n_name END ELSE s_name END AS citation
  FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey) GROUP BY outcome""")
def backfill_citation(t):
    s = t.supplier.select(
        F.col("s_nationkey").alias("site"),
        F.when(F.col("s_acctbal") >= 3000, F.col("s_name")).alias("citation"),
    )
    n = t.nation.select(
        F.col("n_nationkey").alias("site"),
        F.when(F.endswith("n_name", F.lit("7")), "").otherwise(F.col("n_name")).alias("citation"),
    )
    return catalog.backfill(s, n, "site", "citation").groupBy("outcome").agg(
        F.count("*").alias("n"), F.count("citation").alias("n_citations")
    )


@query("provider_citations", """
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 0 WHEN p_size % 5 = 3 THEN 2 ELSE p_size % 5 END::BIGINT AS n_citations,
  CASE p_size % 5 WHEN 0 THEN '' WHEN 1 THEN p_name WHEN 4 THEN p_name || '|' || p_brand || '|' || p_type || '|x' ELSE p_name || '|' || p_brand END AS citations
FROM part""")
def provider_citations(t):
    stem, size = "dataset_provider_citation_", F.col("p_size") % 5
    # Numbers 1..n; for n = 3 the third is missing and a fourth is never reached.
    entries = [("1", F.col("p_name"), size >= 1), ("2", F.col("p_brand"), size >= 2),
               ("3", F.col("p_type"), size == 4), ("4", F.lit("x"), size >= 3)]
    pairs = F.filter(F.array(*[
        F.struct(F.lit(stem + n).alias("k"), F.when(on, v).alias("v")) for n, v, on in entries
    ]), lambda p: p["v"].isNotNull())
    out = t.part.select("p_partkey", F.map_from_entries(pairs).alias("attrs"))
    cites = catalog.citation_list("attrs")
    return out.select(
        "p_partkey", F.size(cites).cast("bigint").alias("n_citations"),
        F.array_join(cites, "|").alias("citations"),
    )


@query("ingest_report", """
SELECT CASE o_orderstatus WHEN 'O' THEN 'processed' WHEN 'F' THEN 'failed' ELSE 'skipped' END AS status,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS reason, count(*) AS n FROM orders GROUP BY ALL""")
def ingest_report(t):
    status = (
        F.when(F.col("o_orderstatus") == "O", "processed")
        .when(F.col("o_orderstatus") == "F", "failed").otherwise("skipped")
    )
    reason = F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority"))
    return catalog.ingest_report(t.orders.select(status.alias("status"), reason.alias("reason")))


# --- gas files ----------------------------------------------------------------------------------


def _gas_facts(t):
    from ..sources import gas

    rows = A.gas_rows(t).select(
        "file_name", "time", "value", "value_std_dev", "std_unit", "qc_flag",
        F.col("height").cast("double").alias("altitude"), F.col("qc_flag").alias("instrument"),
        F.lit(None).cast("double").alias("intake_height"), F.col("seq").alias("obs_num"),
    )
    return gas.to_facts(rows, units={"value_std_dev": "std_unit"})


@query("gas_facts", f"""WITH {A.GAS_SQL}
SELECT gas, upper(trigram) || CASE WHEN height = 10 THEN 0 ELSE height END AS station_id, CASE gas WHEN 'co2' THEN 'ppm' ELSE 'ppb' END AS unit,
  count(*) AS n, round(avg(value * CASE gas WHEN 'co2' THEN 1e6 ELSE 1e9 END), 4) AS mean_value FROM gas_rows WHERE gas IS NOT NULL GROUP BY ALL""")
def gas_facts(t):
    return _gas_facts(t).groupBy("gas", "station_id", "unit").agg(
        F.count("*").alias("n"), F.round(F.avg("value"), 4).alias("mean_value")
    )


@query("station_constants", f"""WITH {A.GAS_SQL}, f AS (
  SELECT gas, upper(trigram) || CASE WHEN height = 10 THEN 0 ELSE height END AS station_id, height::DOUBLE AS altitude, qc_flag FROM gas_rows WHERE gas IS NOT NULL)
SELECT station_id, gas, 'altitude' AS name, CAST(max(altitude) AS VARCHAR) AS text FROM f GROUP BY ALL HAVING min(altitude) = max(altitude)
UNION ALL SELECT station_id, gas, 'instrument', max(qc_flag) FROM f GROUP BY station_id, gas HAVING min(qc_flag) = max(qc_flag)
UNION ALL SELECT station_id, gas, 'intake_height', NULL FROM f GROUP BY station_id, gas""")
def station_constants(t):
    from ..sources import gas

    return gas.station_constants(_gas_facts(t))


@query("gas_wide_export", f"""WITH {A.GAS_SQL}
SELECT upper(trigram) || CASE WHEN height = 10 THEN 0 ELSE height END AS station_id, time AS time_ch4, round(value * 1e9, 6) AS ch4, qc_flag AS ch4_qc_flag
FROM gas_rows WHERE gas = 'ch4'""")
def gas_wide_export(t):
    from ..sources import gas

    out = gas.wide_export(_gas_facts(t), "ch4", ["station_id"])
    return out.select("station_id", "time_ch4", F.round("ch4", 6).alias("ch4"), "ch4_qc_flag")


# --- documents ----------------------------------------------------------------------------------


def _collections(t):
    """Collection documents put together from the parts of each brand, as JSON text."""
    name = F.concat(
        F.lit("ICOSETC_SE-"), F.col("p_partkey").cast("string"),
        F.when(F.col("p_size") < 17, "_ARCHIVE_L2.zip")
        .when(F.col("p_size") < 34, "_METEOSENS_L2.csv").otherwise("_x.nc"),
    )
    res = F.concat(F.lit("https://example.org/objects/h"), F.col("p_partkey").cast("string"))
    doc = F.to_json(F.struct(F.array(F.struct(name.alias("name"), res.alias("res"))).alias(
        "members")))
    return t.part.select(F.from_json(doc, documents.COLLECTION).alias("d")).select("d.*")


@query("collection_members", """
SELECT 'ICOSETC_SE-' || p_partkey || '_x.nc' AS name, 'https://example.org/objects/h' || p_partkey AS res, 'h' || p_partkey AS hash_id
FROM part WHERE p_size >= 34""")
def collection_members(t):
    return documents.members(_collections(t), ".nc")


@query("archive_members", """
SELECT 'SE-' || p_partkey AS site_id, 'h' || p_partkey AS hash_id FROM part WHERE p_size < 17""")
def archive_members(t):
    return documents.archive_members(_collections(t)).select("site_id", "hash_id")


@query("sensor_members", """
SELECT 'SE-' || p_partkey AS site_id, 'https://example.org/objects/h' || p_partkey AS res FROM part WHERE p_size >= 17 AND p_size < 34""")
def sensor_members(t):
    return documents.sensor_members(_collections(t))


def _station_documents(t):
    """Station documents of the customers; staff are the customer and its nation."""
    role = F.when(F.col("c_nationkey") % 3 == 0, "Data Manager").otherwise("Principal Investigator")

    def person(first, last, end):
        return F.struct(
            F.struct(first.alias("firstName"), last.alias("lastName")).alias("person"),
            F.struct(end.alias("end"), F.struct(role.alias("label")).alias("role")).alias("role"),
        )

    staff = F.array(
        person(F.col("c_name"), F.col("c_mktsegment"), F.lit(None).cast("string")),
        person(F.lit("Old"), F.col("c_name"), F.lit("2001-01-01")),
        person(F.lit("New"), F.col("c_mktsegment"), F.lit(None).cast("string")),
    )
    doc = F.to_json(F.struct(
        F.struct((F.col("c_custkey") % 90).cast("double").alias("lat"), F.lit(5.5).alias("lon"),
                 F.col("c_acctbal").alias("alt")).alias("location"),
        F.concat(F.lit("C"), F.col("c_nationkey").cast("string")).alias("countryCode"),
        F.struct(F.when(F.col("c_nationkey") == 4, "").otherwise(F.col("c_name")).alias("name"))
        .alias("org"),
        F.struct(
            F.lit("1").alias("stationClass"), (F.col("c_nationkey") - 12).alias("timeZoneOffset"),
            F.struct(F.col("c_mktsegment").alias("label")).alias("ecosystemType"),
        ).alias("specificInfo"),
        staff.alias("staff"),
    ))
    parsed = t.customer.select(
        F.col("c_custkey").cast("string").alias("source_file"),
        F.from_json(doc, documents.STATION).alias("d"),
    )
    return parsed.select("source_file", "d.*")


@query("ecosystem_stations", """
SELECT c_custkey::VARCHAR AS source_file, (c_custkey % 90)::DOUBLE AS geospatial_lat, c_acctbal AS station_elevation, 'C' || c_nationkey AS country,
  CASE WHEN c_nationkey < 12 THEN 'UTC-' ELSE 'UTC+' END || lpad(abs(c_nationkey - 12)::VARCHAR, 2, '0') || ':00' AS time_zone, c_mktsegment AS ecosystem,
  CASE WHEN c_nationkey % 3 <> 0 THEN c_name || ' ' || c_mktsegment || ', New ' || c_mktsegment END AS principal_investigator,
  CASE WHEN c_nationkey % 3 = 0 THEN c_name || ' ' || c_mktsegment || ', New ' || c_mktsegment END AS data_manager
FROM customer""")
def ecosystem_stations(t):
    return documents.ecosystem_stations(_station_documents(t)).select(
        "source_file", "geospatial_lat", "station_elevation", "country", "time_zone", "ecosystem",
        "principal_investigator", "data_manager",
    )


@query("atmosphere_stations", """
SELECT c_custkey::VARCHAR AS source_file, CASE WHEN c_nationkey <> 4 THEN c_name END AS station_full_name, 'C' || c_nationkey AS country_code,
  CAST(c_nationkey - 12 AS INTEGER) AS time_zone_offset,
  CASE WHEN c_nationkey % 3 <> 0 THEN c_name || ' ' || c_mktsegment || '; Old ' || c_name || '; New ' || c_mktsegment END AS current_pi
FROM customer""")
def atmosphere_stations(t):
    return documents.atmosphere_stations(_station_documents(t)).select(
        "source_file", "station_full_name", "country_code", "time_zone_offset", "current_pi"
    )


@query("column_instruments", """
SELECT p_partkey::VARCHAR AS source_file, 'TA_1_' || p_size || '_2' AS "column", 'TA' AS base, 1 AS r, CAST(p_size AS INTEGER) AS h, 2 AS v, p_name AS instrument,
  CASE WHEN p_size % 2 = 0 THEN p_brand ELSE '' END AS instrument_description, p_size % 3 = 0 AS ongoing FROM part WHERE p_size <= 40""")
def column_instruments(t):
    comments = F.when(F.col("p_size") % 2 == 0, F.array("p_brand", F.lit("second")))
    deployment = F.struct(
        F.struct(F.col("p_name").alias("label"), F.lit("u").alias("uri"),
                 comments.alias("comments")).alias("instrument"),
        F.struct(F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"), F.lit(3.0).alias("alt")).alias(
            "pos"),
        F.lit("2020-01-01T00:00:00Z").alias("start"),
        F.when(F.col("p_size") % 3 != 0, "2021-01-01T00:00:00Z").alias("stop"),
    )
    column = F.struct(
        F.concat(F.lit("TA_1_"), F.col("p_size").cast("string"), F.lit("_2")).alias("label"),
        F.when(F.col("p_size") <= 40, F.array(deployment)).alias("instrumentDeployments"),
    )
    doc = F.to_json(F.struct(F.struct(F.array(column).alias("columns")).alias("specificInfo")))
    parsed = t.part.select(
        F.col("p_partkey").cast("string").alias("source_file"),
        F.from_json(doc, documents.OBJECT).alias("d"),
    ).select("source_file", "d.*")
    return documents.instrument_deployments(parsed).select(
        "source_file", "column", "base", "r", "h", "v", "instrument", "instrument_description",
        F.col("stop").isNull().alias("ongoing"),
    )


@query("object_citations", """
SELECT page_id::VARCHAR AS source_file, CASE WHEN page_id % 4 = 0 THEN '' ELSE 'https://hdl.handle.net/11676/' || page_id END AS pid_url,
  regexp_replace(html, '<[^>]+>', '', 'g') AS citation FROM pages""")
def object_citations(t):
    doc = F.to_json(F.struct(
        F.when(F.col("page_id") % 4 != 0,
               F.concat(F.lit("11676/"), F.col("page_id").cast("string"))).alias("pid"),
        F.struct(F.col("html").alias("citationString")).alias("references"),
    ))
    parsed = t.pages.select(
        F.col("page_id").cast("string").alias("source_file"),
        F.from_json(doc, documents.OBJECT).alias("d"),
    ).select("source_file", "d.*")
    return documents.object_citations(parsed)


@query("plain_text", """
SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS text FROM pages""")
def plain_text(t):
    return t.pages.select("page_id", names.strip_tags("html").alias("text"))


# --- landed text files --------------------------------------------------------------------------


_SPLIT = r"string_split_regex(text, '\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]')"


@query("skip_preamble", f"""
WITH l AS (SELECT doc_id, unnest({_SPLIT}) AS line, unnest(range(0, len({_SPLIT}))) AS line_no FROM documents),
 h AS (SELECT doc_id, coalesce(min(CASE WHEN line LIKE 'The%' THEN line_no END), 0) AS head FROM l GROUP BY doc_id)
SELECT doc_id, count(*) AS n_lines, sum(length(line))::BIGINT AS n_chars, CAST(min(line_no) AS INTEGER) AS header_line FROM l JOIN h USING (doc_id) WHERE line_no >= head GROUP BY doc_id
""")
def skip_preamble(t):
    return ocean_csv.body_lines(t.documents, "doc_id", "text", "The").groupBy("doc_id").agg(
        F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"),
        F.min("line_no").alias("header_line"),
    )


@query("ocean_column_names", """
WITH l AS (SELECT l_orderkey AS file, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos, l_linenumber FROM lineitem),
 n AS (SELECT file, pos, ['Date/Time', 'Temp [degC]', 'Temp [degC] QC Flag', 'fCO2 [uatm]', 'Odd label (x)', 'Temp [degC] QC Comment', 'Obs Type'][l_linenumber] AS label FROM l)
SELECT file, pos, label, CASE nth WHEN 1 THEN base ELSE base || '_' || nth END AS short_name FROM (
  SELECT *, row_number() OVER (PARTITION BY file, base ORDER BY pos) AS nth FROM (
   SELECT *, CASE label WHEN 'Date/Time' THEN 'time' WHEN 'Temp [degC]' THEN 'Temp' WHEN 'Temp [degC] QC Flag' THEN 'Temp_QC' WHEN 'fCO2 [uatm]' THEN 'fCO2' ELSE 'Odd_label_x' END AS base
   FROM n WHERE label NOT LIKE '% QC Comment' AND label NOT LIKE '% Type'))""")
def ocean_column_names(t):
    from pyspark.sql import Window

    labels = ["Date/Time", "Temp [degC]", "Temp [degC] QC Flag", "fCO2 [uatm]", "Odd label (x)",
              "Temp [degC] QC Comment", "Obs Type"]
    # Columns of one header: the lines of one order.
    w = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    head = t.lineitem.select(
        F.col("l_orderkey").alias("file"), F.row_number().over(w).cast("bigint").alias("pos"),
        F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("l_linenumber")).alias("label"),
    )
    return ocean_csv.short_names(head, "file", "pos", "label").select(
        "file", "pos", "label", "short_name"
    )


@query("ocean_rows", """
SELECT variable, qc, count(*) AS n, count(value) AS n_values FROM (
  SELECT unnest(['Temp', 'fCO2']) AS variable, unnest([try_cast(substr(o_orderpriority, 1, 1) AS DOUBLE), try_cast(o_orderstatus AS DOUBLE)]) AS value,
    unnest([coalesce(try_cast(substr(o_orderpriority, 1, 1) AS INTEGER), -1), coalesce(try_cast(o_orderstatus AS INTEGER), -1)]) AS qc
  FROM orders WHERE o_orderstatus <> 'P') GROUP BY ALL""")
def ocean_rows(t):
    # Orders in progress carry no readable stamp and are dropped.
    stamp = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    o = t.orders.select(
        stamp.alias("stamp"), F.substring("o_orderpriority", 1, 1).alias("p"),
        F.col("o_orderstatus").alias("s"),
    )
    rows = ocean_csv.to_rows(
        ocean_csv.good_times(o, "stamp"), ["time"], {"Temp": ("p", "p"), "fCO2": ("s", "s")}
    )
    return rows.groupBy("variable", F.col("qc").cast("int").alias("qc")).agg(
        F.count("*").alias("n"), F.count("value").alias("n_values")
    )


# --- rasters ------------------------------------------------------------------------------------


@query("raster_catalogue", """
SELECT make_date(2020, 1 + CAST(vec_id % 12 AS INTEGER), 1 + CAST(vec_id % 31 AS INTEGER)) AS date, count(*) AS n FROM embeddings
WHERE vec_id % 12 IN (0, 2, 4, 6, 7, 9, 11) OR (vec_id % 12 = 1 AND vec_id % 31 < 29) OR (vec_id % 12 IN (3, 5, 8, 10) AND vec_id % 31 < 30)
GROUP BY 1 HAVING make_date(2020, 1 + CAST(any_value(vec_id) % 12 AS INTEGER), 1 + CAST(any_value(vec_id) % 31 AS INTEGER)) BETWEEN DATE '2020-02-01' AND DATE '2020-11-15'""")
def raster_catalogue(t):
    path = F.format_string(
        "landing/GPP_2020_%02d_%02d.tif", F.col("vec_id") % 12 + 1, F.col("vec_id") % 31 + 1
    )
    files = t.embeddings.select(path.alias("path"))
    return raster_source.catalogue(files, "path", "2020-02-01", "2020-11-15").groupBy("date").agg(
        F.count("*").alias("n")
    )


@query("quantise_tiles", f"""WITH {A.TILES_SQL}
SELECT file, array_to_string(list_transform(data, lambda x: CASE WHEN x = -9999 THEN -9999 ELSE CAST(round_even(CAST(CAST(x AS FLOAT) * 0.001::FLOAT / 0.1::FLOAT AS DOUBLE), 0) AS INTEGER) END), ',') AS cells, 0.1::DOUBLE AS scale FROM tiles""")
def quantise_tiles(t):
    q = raster_source.encode_tiles(A.tiles(t))
    cells = F.array_join(F.transform("data", lambda x: x.cast("string")), ",")
    return q.select("file", cells.alias("cells"), "scale")


@query("decode_tiles", f"""WITH {A.TILES_SQL}
SELECT file, round(list_sum(list_transform(list_filter(data, lambda x: x <> -9999), lambda x: x * 0.001::DOUBLE)), 6) AS total,
  len(list_filter(data, lambda x: x = -9999))::INTEGER AS n_missing FROM tiles""")
def decode_tiles(t):
    v = raster.decode("data", F.lit(0.001))
    total = F.aggregate(F.filter(v, lambda x: x.isNotNull()), F.lit(0.0), lambda a, x: a + x)
    missing = F.size(F.filter(v, lambda x: x.isNull()))
    return A.tiles(t).select(
        "file", F.round(total, 6).alias("total"), missing.alias("n_missing")
    )


@query("tile_coordinates", f"""WITH {A.TILES_SQL}
SELECT file, round(-25.0::DOUBLE + (tile_col * 8 + 0.5::DOUBLE) * 0.01::DOUBLE, 9) AS lon0, round(72.0::DOUBLE + (tile_row * 8 + 0.5::DOUBLE) * -0.01::DOUBLE, 9) AS lat0 FROM tiles""")
def tile_coordinates(t):
    g = t.region.filter("r_regionkey = 0").select(
        F.lit(-25.0).alias("x0"), F.lit(0.01).alias("dx"), F.lit(72.0).alias("y0"),
        F.lit(-0.01).alias("dy"),
    )
    out = raster_source.tile_coordinates(A.tiles(t), g, 8)
    return out.select("file", F.round("lon0", 9).alias("lon0"), F.round("lat0", 9).alias("lat0"))


@query("monthly_stack", f"""WITH {A.TILES_SQL}
SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, count(DISTINCT date) AS n_days, count(*) AS n_files, sum(len(data) * 2)::BIGINT AS bytes
FROM tiles WHERE month(date) <> 2 GROUP BY ALL""")
def monthly_stack(t):
    """Months the store lacks; the store of the example holds February."""
    tiles = A.tiles(t)
    stored = tiles.filter(F.month("date") == 2)
    new = raster_source.missing_months(tiles, stored)
    sized = new.withColumn("size", (F.size("data") * 2).cast("bigint"))
    return aggregates.files_per_month(sized, "date", "size")


@query("last_tile_of_day", f"""WITH {A.TILES_SQL}
SELECT date, tile_col, max(file) AS file FROM tiles GROUP BY ALL""")
def last_tile_of_day(t):
    return joins.last_row_wins(A.tiles(t), ["date", "tile_col"], ["file"], ["file"])
