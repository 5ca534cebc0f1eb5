from datetime import datetime

from pyspark.sql import functions as F

from geoobs.functions import clean, names
from geoobs.operators import joins, reshape

HEADER = [
    "TIMESTAMP_START", "TIMESTAMP_END", "NEE_VUT_REF", "NEE_VUT_REF_QC", "NEE_VUT_05",
    "NEE_VUT_REF_RANDUNC_N", "GPP_DT_CUT_MEAN", "TS_F_MDS_2", "LE_CORR_75", "H_CORR", "TA_1_10_2",
    "TA_1_10_2_N", "CO2_DRY_7", "CO2_DRY_14", "G_1", "SWC_3", "SWC_3_QC", "FETCH_MAX", "TA_F",
]


def _by_column(columns):
    return {r.column: r for r in reshape.classify_columns(columns)}


def test_families():
    roles = _by_column(HEADER)
    assert roles["NEE_VUT_05"].labels == {"ustar_threshold": "VUT", "nee_variant": "p05"}
    assert roles["NEE_VUT_REF_QC"].stat == "qc"
    assert roles["NEE_VUT_REF_RANDUNC_N"].family == "plain"
    assert roles["GPP_DT_CUT_MEAN"].labels["partition_method"] == "DT"
    assert roles["LE_CORR_75"].labels == {"corr_pct": "p75"}
    assert roles["H_CORR"].labels == {"corr_pct": "p50"}
    assert roles["TA_1_10_2"].labels == {"r": 1, "h": 10, "v": 2}
    assert roles["CO2_DRY_14"].labels == {"level": 14}
    assert roles["G_1"].family == "plain"  # one index without a statistic stays 1-D
    assert roles["SWC_3"].family == "level"  # one index with value and flag collapses
    assert "TIMESTAMP_START" not in roles


def test_name_collisions():
    roles = reshape.classify_columns(["TS_F_MDS_1", "TS_1_1_1", "TS_4", "TS_5", "TS"])
    names_ = reshape.resolve_names(roles)
    assert [names_[k] for k in (("soil", "TS"), ("profile", "TS"), ("level", "TS"), ("plain", "TS"))
            ] == ["TS", "TS_obs", "TS_obs2", "TS_raw"]


def test_long_form_and_back(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 0.5, -9999.0, 3.0), ("b", float("nan"), 2.5, 2.0, -9999.0)],
        "k STRING, NEE_VUT_REF DOUBLE, NEE_VUT_REF_QC DOUBLE, TA_1_1_1 DOUBLE, TA_F DOUBLE",
    )
    roles = reshape.classify_columns(df.columns[1:])
    long = reshape.to_long(df, ["k"], roles)
    got = {(r["k"], r["variable"]): (r["value"], r["qc"]) for r in long.collect()}
    # 0.5 and 2.5 round to the even neighbour; missing cells have no row unless a flag remains.
    assert got == {("a", "NEE"): (1.0, 0.0), ("a", "TA_F"): (3.0, None),
                   ("b", "NEE"): (None, 2.0), ("b", "TA"): (2.0, None)}
    dense = reshape.densify(long, ["k"], "variable", ["NEE", "TA", "X"])
    assert dense.count() == 6


def test_cleaning(spark):
    df = spark.createDataFrame(
        [("-9999",), ("-9999.0",), ("nan",), ("x",), ("1.5",), (None,)], "v STRING")
    got = [r[0] for r in df.select(clean.clean_value("v")).collect()]
    assert got == [None, None, None, None, 1.5, None]
    flags = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (7.0,), (None,)], "q DOUBLE")
    assert [r[0] for r in flags.select(clean.clean_qc("q")).collect()] == [0, 2, 2, 3, None]
    ends = spark.createDataFrame(
        [("20200131", "MM"), ("202001010030", "HH"), ("2020", "YY")], "t STRING, f STRING")
    ends = ends.select(clean.period_end(clean.parse_flux_time("t"), "f"))
    assert [r[0] for r in ends.collect()] == [
        datetime(2020, 2, 29), datetime(2020, 1, 1, 1), datetime(2021, 1, 1)]


def test_narrow(spark):
    df = spark.createDataFrame(
        [(1.0, 300.0, 0.5, None, "a"), (-128.0, 1.0, 2.0, None, "1")],
        "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE, e STRING")
    out = reshape.narrow(df, df.columns)
    assert dict(out.dtypes) == {"a": "tinyint", "b": "smallint", "c": "float", "d": "float"}


def test_keys_and_addresses(spark):
    keys = ["SE-Svb/NEE/0.0.0", "SE-Svb/fluxes_dd/GPP/0.0", "119920250401/Temp/0", "A/B/12/34",
            "NEE", "1/2/3"]
    df = spark.createDataFrame([(k,) for k in keys], "key STRING")
    got = [tuple(r) for r in df.select(names.group_path("key"), names.array_name("key")).collect()]
    assert got == [("SE-Svb", "NEE"), ("SE-Svb/fluxes_dd", "GPP"), ("119920250401", "Temp"),
                   ("A", "B"), ("", "NEE"), ("", "1")]
    ip = spark.createDataFrame(
        [("192.168.1.42",), ("2001:db8:85a3::8a2e:370:7334",)], "ip STRING")
    assert [r[0] for r in ip.select(names.anonymise_ip("ip")).collect()] == [
        "192.168.1.0/24", "2001:db8:85a3::/48"]
    parts = spark.createDataFrame(
        [("0",), ("0.0.0",), ("12.34",), ("NEE",), ("",), (".zarray",)], "p STRING")
    assert [r[0] for r in parts.select(names.is_chunk_index("p")).collect()] == [
        True, True, True, False, False, False]


def test_shared_variables_leave_all_products(spark):
    mapping = spark.createDataFrame(
        [("a", "TA"), ("b", "TA_QC"), ("a", "NEE"), ("b", "H_FLAG"), ("c", "H_QC")],
        "product STRING, column STRING")
    loose = {r[0] for r in joins.duplicate_variables(mapping).collect()}
    assert loose == {"TA", "TA_QC", "H_FLAG", "H_QC"}
    assert joins.duplicate_variables(mapping, strict_names=True).count() == 0


def test_position_fallback_is_per_deployment(spark):
    rows = spark.createDataFrame(
        [("ship", 1.0, 2.0, 0, 0), ("ship", 3.0, 4.0, 3, 0), ("buoy", 9.0, 9.0, -1, -1)],
        "deployment STRING, lon DOUBLE, lat DOUBLE, lon_qc INT, lat_qc INT")
    dim = spark.createDataFrame(
        [("ship", True, 50.0, 60.0), ("buoy", False, 10.0, 20.0)],
        "deployment STRING, has_position BOOLEAN, lat DOUBLE, lon DOUBLE")
    out = joins.with_position_fallback(rows, dim).select("deployment", "lon", "lat")
    assert sorted(map(tuple, out.collect()), key=str) == [
        ("buoy", 20.0, 10.0), ("ship", 1.0, 2.0), ("ship", None, None)]


def test_long_name_of_unknown_root(spark):
    df = spark.createDataFrame([("X2M_DRY_1_2_3",), ("TA_FLAG",)], "n STRING")
    d = names.describe_variable("n")
    got = [r[0] for r in df.select(d["long_name"]).collect()]
    assert got == ["X2M Dry", "Quality Control Flag for Air Temperature"]
    assert df.select(F.count("*")).first()[0] == 2
