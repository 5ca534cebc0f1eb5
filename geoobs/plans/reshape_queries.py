"""Wide columns to labelled rows and back (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import reshape
from . import adapters as A
from .registry import query


def _long(t, *variables, columns=()):
    """Long rows of some variables, or of the named columns."""
    w = A.wide_flux(t)
    roles = reshape.classify_columns([c for c in w.columns if c not in A.WIDE_KEYS])
    picked = reshape.pick(roles, *variables)
    if columns:
        picked = [r for r in roles if r.column in columns]
    return reshape.to_long(w, A.WIDE_KEYS, picked, stored=reshape.resolve_names(roles))


def _agg(df, *keys):
    return df.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.count("value").alias("n_values"),
        F.round(F.avg("value"), 6).alias("mean_value"),
        F.round(F.avg("qc"), 6).alias("mean_qc"),
    )


def _cell(label: str, value: str, qc: str = "NULL", extra: str = "") -> str:
    q = f"CAST(greatest(0, least(3, round_even({qc}, 0))) AS DOUBLE)" if qc != "NULL" else "NULL::DOUBLE"
    return (f"SELECT {label}, nullif({value}, -9999.0::DOUBLE) AS value, {q} AS qc{extra} FROM wide")


_AGG = ("count(*) AS n_rows, count(value) AS n_values, round(avg(value), 6) AS mean_value, "
        "round(avg(qc), 6) AS mean_qc")


@query("column_roles", f"""WITH {A.WIDE_SQL}, n AS (SELECT count(*) AS n, count(nullif("TA_F", -9999)) AS m FROM wide)
SELECT variable, family, n_columns, CAST(cells * n AS BIGINT) AS n_rows FROM n, (VALUES ('CO2_DRY', 'level', 3, 2),
 ('G_1', 'plain', 1, 1), ('LE_CORR', 'energy', 3, 3), ('NEE', 'nee', 6, 4), ('NEE_VUT_REF_RANDUNC_METHOD', 'plain', 1, 1),
 ('RECO', 'partitioned', 2, 1), ('SWC', 'soil', 1, 1), ('TA', 'profile', 3, 1), ('TA_F_QC', 'plain', 1, 1),
 ('TS', 'soil', 2, 1)) AS v(variable, family, n_columns, cells)
UNION ALL SELECT variable, family, n_columns, m FROM n, (VALUES ('GPP', 'partitioned', 1), ('TA_F', 'plain', 1)) AS v(variable, family, n_columns)""")
def column_roles(t):
    w = A.wide_flux(t)
    roles = reshape.classify_columns([c for c in w.columns if c not in A.WIDE_KEYS])
    families = reshape.mapping_table(t.spark, roles).groupBy("variable", "family").agg(
        F.count("*").cast("int").alias("n_columns")
    )
    rows = reshape.to_long(w, [], roles).groupBy("variable").agg(F.count("*").alias("n_rows"))
    return families.join(rows, "variable")


@query("nee_family", f"""WITH {A.WIDE_SQL}, long AS (
 {_cell("'VUT' AS ustar_threshold, 'REF' AS nee_variant", '"NEE_VUT_REF"', '"NEE_VUT_REF_QC"', ', "NEE_VUT_REF_RANDUNC" AS randunc')}
 UNION ALL {_cell("'VUT', 'p16'", '"NEE_VUT_16"', extra=', NULL')}
 UNION ALL {_cell("'VUT', 'p84'", '"NEE_VUT_84"', extra=', NULL')}
 UNION ALL {_cell("'CUT', 'p50'", '"NEE_CUT_50"', extra=', NULL')})
SELECT ustar_threshold, nee_variant, {_AGG}, round(avg(randunc), 6) AS mean_randunc FROM long GROUP BY ALL""")
def nee_family(t):
    n = _long(t, "NEE")
    return n.groupBy("ustar_threshold", "nee_variant").agg(
        F.count("*").alias("n_rows"), F.count("value").alias("n_values"),
        F.round(F.avg("value"), 6).alias("mean_value"), F.round(F.avg("qc"), 6).alias("mean_qc"),
        F.round(F.avg("randunc"), 6).alias("mean_randunc"),
    )


@query("partitioned_family", f"""WITH {A.WIDE_SQL}, long AS (
 {_cell("'GPP' AS variable, 'NT' AS partition_method, 'VUT' AS ustar_threshold, 'REF' AS nee_variant", '"GPP_NT_VUT_REF"')}
 UNION ALL {_cell("'RECO', 'DT', 'CUT', 'MEAN'", '"RECO_DT_CUT_MEAN"', '"RECO_DT_CUT_MEAN_QC"')})
SELECT variable, partition_method, ustar_threshold, nee_variant, {_AGG} FROM long
WHERE value IS NOT NULL OR qc IS NOT NULL GROUP BY ALL""")
def partitioned_family(t):
    long = _long(t, "GPP", "RECO")
    return _agg(long, "variable", "partition_method", "ustar_threshold", "nee_variant")


@query("soil_layers", f"""WITH {A.WIDE_SQL}, long AS (
 {_cell("'TS' AS variable, 1 AS soil_layer", '"TS_F_MDS_1"', '"TS_F_MDS_1_QC"')}
 UNION ALL {_cell("'SWC', 2", '"SWC_F_MDS_2"')})
SELECT variable, soil_layer, {_AGG} FROM long GROUP BY ALL""")
def soil_layers(t):
    return _agg(_long(t, "TS", "SWC"), "variable", "soil_layer")


@query("energy_correction", f"""WITH {A.WIDE_SQL}, long AS (
 {_cell("'LE_CORR' AS variable, 'p25' AS corr_pct", '"LE_CORR_25"')}
 UNION ALL {_cell("'LE_CORR', 'p50'", '"LE_CORR"')} UNION ALL {_cell("'LE_CORR', 'p75'", '"LE_CORR_75"')})
SELECT variable, corr_pct, {_AGG} FROM long GROUP BY ALL""")
def energy_correction(t):
    return _agg(_long(t, "LE_CORR"), "variable", "corr_pct")


@query("sensor_profile", f"""WITH {A.WIDE_SQL}
SELECT site_id, 'TA' AS variable, 1 AS r, 10 AS h, 2 AS v, count(nullif("TA_1_10_2", -9999)) AS n_values,
       sum("TA_1_10_2_N")::BIGINT AS samples, round(avg("TA_1_10_2_SE"), 6) AS mean_se
FROM wide GROUP BY site_id""")
def sensor_profile(t):
    return _long(t, "TA").groupBy("site_id", "variable", "r", "h", "v").agg(
        F.count("value").alias("n_values"), F.sum("n").cast("bigint").alias("samples"),
        F.round(F.avg("se"), 6).alias("mean_se"),
    )


@query("level_axis", f"""WITH {A.WIDE_SQL}
SELECT 'CO2_DRY' AS variable, 7 AS level, count(*) AS n_rows, round(avg("CO2_DRY_7"), 6) AS mean_value, NULL::DOUBLE AS mean_sd FROM wide
UNION ALL SELECT 'CO2_DRY', 9, count(*), round(avg("CO2_DRY_9"), 6), round(avg("CO2_DRY_9_SD"), 9) FROM wide""")
def level_axis(t):
    return _long(t, "CO2_DRY").groupBy("variable", "level").agg(
        F.count("*").alias("n_rows"), F.round(F.avg("value"), 6).alias("mean_value"),
        F.round(F.avg("sd"), 9).alias("mean_sd"),
    )


@query("plain_variables", f"""WITH {A.WIDE_SQL}, long AS (
 {_cell("'G_1' AS variable", '"G_1"')} UNION ALL {_cell("'TA_F'", '"TA_F"')}
 UNION ALL {_cell("'TA_F_QC'", '"TA_F_QC"')}
 UNION ALL {_cell("'NEE_VUT_REF_RANDUNC_METHOD'", '"NEE_VUT_REF_RANDUNC_METHOD"')})
SELECT variable, {_AGG} FROM long WHERE value IS NOT NULL GROUP BY variable""")
def plain_variables(t):
    plain = _long(t, "G_1", "TA_F", "TA_F_QC", "NEE_VUT_REF_RANDUNC_METHOD")
    return _agg(plain, "variable")


@query("name_collisions", """
SELECT * FROM (VALUES ('TS', 'soil', 'TS'), ('TS', 'profile', 'TS_obs'), ('TS', 'level', 'TS_obs2'),
  ('TA', 'plain', 'TA'), ('LE_CORR', 'energy', 'LE_CORR'), ('TS', 'plain', 'TS_raw'))
  AS v(base, family, stored) WHERE (SELECT count(*) FROM lineitem) > 0""")
def name_collisions(t):
    # A header whose soil, profile, level and plain columns share one base name.
    w = t.lineitem.select(
        F.col("l_quantity").alias("TS_F_MDS_1"), F.col("l_tax").alias("TS_1_1_1"),
        F.col("l_discount").alias("TS_1"), F.col("l_quantity").alias("TS_2"),
        F.col("l_quantity").alias("TA"), F.col("l_quantity").alias("LE_CORR"),
        F.col("l_quantity").alias("TS"),
    )
    roles = reshape.classify_columns(w.columns)
    names = reshape.resolve_names(roles)
    long = reshape.to_long(w, [], roles).select("variable").distinct()
    pairs = [(base, family, stored) for (family, base), stored in names.items()]
    mapping = t.spark.createDataFrame(pairs, "base STRING, family STRING, stored STRING")
    return mapping.join(long, mapping["stored"] == long["variable"], "left_semi")


@query("pivot_stations", f"""WITH {A.HOURLY_SQL}
SELECT hour, max(CASE WHEN variable = 'click' THEN value END) AS click, max(CASE WHEN variable = 'error' THEN value END) AS error,
 max(CASE WHEN variable = 'purchase' THEN value END) AS purchase, max(CASE WHEN variable = 'signup' THEN value END) AS signup,
 max(CASE WHEN variable = 'view' THEN value END) AS "view" FROM hourly GROUP BY hour""")
def pivot_stations(t):
    return reshape.pivot_wide(
        A.hourly(t), ["hour"], "variable", ["click", "error", "purchase", "signup", "view"]
    )


@query("pivot_years", """
SELECT year(l_shipdate) AS year, max(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS v_A,
 max(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS v_N, max(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS v_R
FROM lineitem GROUP BY 1""")
def pivot_years(t):
    li = t.lineitem.withColumn("year", F.year("l_shipdate").cast("bigint"))
    return reshape.pivot_wide(li, ["year"], "l_returnflag", ["A", "N", "R"], "l_quantity", "v_")


@query("densify_labels", f"""WITH {A.WIDE_SQL}, k AS (SELECT DISTINCT site_id, product FROM wide),
 long AS ({_cell("site_id, product, 'REF' AS nee_variant", '"NEE_VUT_REF"')}
   UNION ALL {_cell("site_id, product, 'p16'", '"NEE_VUT_16"')} UNION ALL {_cell("site_id, product, 'p84'", '"NEE_VUT_84"')}
   UNION ALL {_cell("site_id, product, 'p50'", '"NEE_CUT_50"')})
SELECT k.site_id, k.product, l.nee_variant, max(long.value) AS value
FROM k, (SELECT unnest(['REF','USTAR50','MEAN','SE','p05','p16','p25','p50','p75','p84','p95']) AS nee_variant) l
LEFT JOIN long ON long.site_id = k.site_id AND long.product = k.product AND long.nee_variant = l.nee_variant
GROUP BY ALL""")
def densify_labels(t):
    n = _long(t, "NEE")
    return reshape.densify(n, ["site_id", "product"], "nee_variant", S.VARIANT_LABELS)


@query("packed_labels", f"""WITH {A.WIDE_SQL}
SELECT site_id, CAST(max("LE_CORR_25") AS DOUBLE) AS p25, max("LE_CORR") AS p50, max("LE_CORR_75") AS p75
FROM wide GROUP BY site_id""")
def packed_labels(t):
    e = _long(t, "LE_CORR")
    packed = reshape.pack_labels(e, ["site_id"], "corr_pct", S.CORR_LABELS)
    return packed.select(
        "site_id", *[F.get("packed", i).alias(p) for i, p in enumerate(S.CORR_LABELS)]
    )


@query("combinable_variables", f"""WITH {A.WIDE_SQL}
SELECT v AS variable, count(*) AS n FROM (
  SELECT unnest(['NEE', 'NEE', 'NEE', 'NEE', 'GPP', 'RECO', 'LE_CORR', 'LE_CORR', 'LE_CORR', 'G_1', 'TA_F', 'TA_F_QC', 'NEE_VUT_REF_RANDUNC_METHOD']) AS v,
         unnest(["NEE_VUT_REF_QC", 0, 0, 0, nullif("GPP_NT_VUT_REF", -9999), 0, 0, 0, 0, 0, nullif("TA_F", -9999), 0, 0]) AS x
  FROM wide) WHERE x IS NOT NULL GROUP BY v""")
def combinable_variables(t):
    return reshape.station_independent(_long(t)).groupBy("variable").agg(F.count("*").alias("n"))


@query("long_round_trip", f"""WITH {A.WIDE_SQL}
SELECT site_id, product, ts_start, max(nullif("NEE_VUT_REF", -9999)) AS nee, max(nullif("TA_F", -9999)) AS ta
FROM wide GROUP BY ALL""")
def long_round_trip(t):
    # G_1 is never missing, so every key keeps a row.
    long = _long(t, columns=("NEE_VUT_REF", "TA_F", "G_1"))
    return long.groupBy(*A.WIDE_KEYS).agg(
        F.max(F.when(F.col("variable") == "NEE", F.col("value"))).alias("nee"),
        F.max(F.when(F.col("variable") == "TA_F", F.col("value"))).alias("ta"),
    )


