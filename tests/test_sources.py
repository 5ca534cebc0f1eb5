import json
import zipfile
from datetime import date, datetime

from pyspark.sql import functions as F

from geoobs import schema as S
from geoobs.operators import catalog, joins
from geoobs.sources import documents, flux_csv, gas, ocean_csv, raster, sinks

HALF_HOURLY = "ICOSETC_SE-Svb_FLUXNET_HH_L2.csv"


def _flux_files(tmp_path):
    (tmp_path / HALF_HOURLY).write_text(
        "TIMESTAMP_START,TIMESTAMP_END,NEE_VUT_REF,\nNEE_VUT_REF_QC,TA_F\n"
        "202001010000,202001010030,1.5,0,-9999\n202001010030,202001010100,-9999,2.5,3\n")
    (tmp_path / "ICOSETC_SE-Svb_FLUXNET_DD_L2.csv").write_text(
        "TIMESTAMP,TA_F\n20200101,4\n20200102,5\n")
    return str(tmp_path)


def test_flux_files_with_wrapped_header(spark, tmp_path):
    by_header = flux_csv.read_all(spark, _flux_files(tmp_path))
    assert len(by_header) == 2
    rows = [r for cols, df in by_header for r in flux_csv.convert(df, cols).collect()]
    got = sorted((r["freq"], str(r["ts_start"]), str(r["ts_end"]), r["variable"], r["value"], r["qc"])
                 for r in rows)
    assert got == [
        ("DD", "2020-01-01 00:00:00", "2020-01-02 00:00:00", "TA_F", 4.0, None),
        ("DD", "2020-01-02 00:00:00", "2020-01-03 00:00:00", "TA_F", 5.0, None),
        ("HH", "2020-01-01 00:00:00", "2020-01-01 00:30:00", "NEE", 1.5, 0.0),
        ("HH", "2020-01-01 00:30:00", "2020-01-01 01:00:00", "NEE", None, 2.0),
        ("HH", "2020-01-01 00:30:00", "2020-01-01 01:00:00", "TA_F", 3.0, None)]
    assert {r["site_id"] for r in rows} == {"SE-Svb"}


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_of_one_header_are_parsed_once(spark, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(flux_csv, "shared_dir",
                        lambda _, purpose: made.append(purpose) or str(tmp_path / "made" / purpose))
    for site in ("SE-Svb", "DE-Tha"):
        (tmp_path / f"ICOSETC_{site}_FLUXNET_DD_L2.csv").write_text(
            'TIMESTAMP,TA_F\n 20200101 ,4\n"20200102",5\nnone,6\n,7\n')
    (tmp_path / "blank.csv").write_text("\n\n")
    ((columns, wide),) = flux_csv.read_all(spark, str(tmp_path / "*.csv"))
    assert wide.columns == ["TIMESTAMP", "TA_F", "source_file"]
    long = flux_csv.convert(wide, columns, "DD")
    got = sorted((r["site_id"], r["freq"], str(r["ts_start"]), r["value"]) for r in long.collect())
    assert got == [(site, "DD", f"2020-01-0{d} 00:00:00", 3.0 + d)
                   for site in ("DE-Tha", "SE-Svb") for d in (1, 2)]
    # Headers are found once, lines of one header are not written again, nor lines and names read twice.
    assert made == ["headers"]
    assert (_plan(long).count("from_csv"), _plan(long).count("regexp_replace")) == (1, 1)


def test_store_is_laid_out_by_one_number(spark, tmp_path):
    rows = [("DD", "main", site, variable, f"20{y:02d}-01-01 00:00:0{y % 2}", "f", float(y))
            for y in (1, 30, 2, 99, 3) for variable in ("TA", "NEE") for site in ("a", None)]
    rows.append(("DD", "main", "a", "TA", None, "f", 0.0))
    df = spark.createDataFrame(
        rows, "freq string, product_group string, site_id string, variable string, ts string, "
        "source_file string, value double").withColumn("ts_start", F.expr("CAST(ts AS TIMESTAMP_NTZ)"))
    store = sinks.flux_store(str(tmp_path / "store"))
    assert "Sort [_sort_key" in _plan(store._laid_out(df))
    store.append(df.repartition(3))
    assert store.read(spark).columns.count("_sort_key") == 0
    held = [(r["site_id"], r["variable"], str(r["ts"] or "")) for r in store.read(spark).collect()]
    assert sorted(held, key=repr) == sorted(((r[2], r[3], r[4] or "") for r in rows), key=repr)
    groups = [h[:2] for h in held]
    assert sum(a != b for a, b in zip(groups, groups[1:])) == len(set(groups)) - 1
    assert all(a <= b for a, b in zip(held, held[1:]) if a[:2] == b[:2])


def test_reingest_replaces_a_site(spark, tmp_path):
    rows = flux_csv.read_all(spark, _flux_files(tmp_path))
    target = str(tmp_path / "store")
    for _ in range(2):
        for cols, df in rows:
            sinks.write_flux(flux_csv.convert(df, cols), target)
    assert sinks.flux_store(target).read(spark).count() == 5


def test_archive_members(spark, tmp_path):
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(f"deep/{HALF_HOURLY}", "h1,h2\n1,2\n")
        z.writestr("ICOSETC_SE-Svb_README_L2.csv", "no")
        z.writestr("ICOSETC_SE-Svb_METEOSENS_INTERIM_L2.csv", "x\n")
    lines = flux_csv.archive_lines(spark, str(path)).orderBy("member", "line_no").collect()
    assert [(r["member"], r["line_no"], r["line"]) for r in lines] == [
        (HALF_HOURLY, 0, "h1,h2"), (HALF_HOURLY, 1, "1,2"),
        ("ICOSETC_SE-Svb_METEOSENS_INTERIM_L2.csv", 0, "x")]


def test_ocean_file(spark, tmp_path):
    path = tmp_path / "SHIP20200101.csv"
    path.write_text("a preamble\nTIMESTAMP,x\n2020-01-01T00:00:00Z,1\n2020-01-01 00:01:00,2\nbad,3\n")
    text = spark.read.text(str(path), wholetext=True).select(F.lit("f").alias("file"), "value")
    body = ocean_csv.body_lines(text, "file", "value").filter("line != ''")
    assert body.filter("is_header").first()["line_no"] == 1
    same = ocean_csv.skip_preamble(ocean_csv.read_lines(spark, str(path)), "file")
    assert same.filter("line != ''").count() == body.count() == 4
    cols = F.split("line", ",")
    rows = body.filter("NOT is_header").select(cols[0].alias("t"), cols[1].alias("x"))
    good = ocean_csv.good_times(rows, "t")
    assert [str(r["time"]) for r in good.orderBy("time").collect()] == [
        "2020-01-01 00:00:00", "2020-01-01 00:01:00"]


def test_ocean_labels(spark):
    labels = ["Date/Time", "Temp [degC]", "Temp [degC] QC Flag", "x (a)", "x (b", "x-a",
              "Temp [degC] QC Comment", "Port Type", "Temp [degC]"]
    df = spark.createDataFrame([("f", i, n) for i, n in enumerate(labels)],
                               "file STRING, pos INT, label STRING")
    out = ocean_csv.short_names(df, "file", "pos", "label").orderBy("pos").collect()
    assert [r["short_name"] for r in out] == [
        "time", "Temp", "Temp_QC", "x_a", "x_b", "x_a_2", "Temp_2"]


def test_documents(spark, tmp_path):
    person = {"firstName": "A", "lastName": "B"}
    doc = {"location": {"lat": 1, "lon": 2}, "countryCode": "SE",
           "specificInfo": {"timeZoneOffset": 1, "documentation": [{"res": "r"}]},
           "staff": [{"person": person, "role": {"role": {"label": "Researcher"}}},
                     {"person": person, "role": {"end": "2020", "role": {"label": "Researcher"}}}]}
    (tmp_path / "s.json").write_text(json.dumps(doc, indent=1))
    s = documents.read_documents(spark, str(tmp_path / "s.json"), documents.STATION)
    row = documents.ecosystem_stations(s).first()
    assert (row["time_zone"], row["researcher"], row["documentation"]) == ("UTC+01:00", "A B", "r")
    obj = {"pid": "11676/x", "references": {"citationString": "<i>T</i>"},
           "specificInfo": {"columns": [{"label": "TA_1_2_3", "instrumentDeployments": [
               {"instrument": {"label": "I", "uri": "u"}, "pos": {"lat": 1, "lon": 2, "alt": 3},
                "start": "2020-01-01T00:00:00Z"}]}, {"label": "none"}]}}
    (tmp_path / "o.json").write_text(json.dumps(obj))
    o = documents.read_documents(spark, str(tmp_path / "o.json"), documents.OBJECT)
    d = documents.instrument_deployments(o).collect()
    assert [(r["base"], r["r"], r["h"], r["v"], r["stop"]) for r in d] == [("TA", 1, 2, 3, None)]
    c = documents.object_citations(o).first()
    assert (c["pid_url"], c["citation"]) == ("https://hdl.handle.net/11676/x", "T")


def test_raster_quantise_and_append(spark, tmp_path):
    tiles = spark.createDataFrame(
        [(date(2020, 1, 1), 0, 0, 1, [50, 150, 250, -9999, 0, 21000])],
        "date DATE, tile_row INT, tile_col INT, file INT, data ARRAY<SMALLINT>")
    q = raster.encode_tiles(tiles).first()["data"]
    import numpy as np

    raw = np.array([50, 150, 250, -9999, 0, 21000], "int16")
    want = np.round(raw.astype("float32") * 0.001 / 0.1).astype("int16")
    want[3] = -9999
    assert q == want.tolist()
    assert raster.encode_tiles(tiles, lossless=True).first()["data"] == raw.tolist()
    from geoobs.streaming import ingest

    write = ingest.append_days(str(tmp_path / "g"))
    later = tiles.withColumn("file", F.lit(2)).withColumn("data", F.array(F.lit(7).cast("smallint")))
    write(tiles.unionByName(later), 0)
    write(later.withColumn("date", F.lit(date(2020, 1, 2))), 1)
    write(later, 2)
    stored = spark.read.parquet(str(tmp_path / "g"))
    assert sorted((str(r["date"]), r["data"]) for r in stored.collect()) == [
        ("2020-01-01", [7]), ("2020-01-02", [7])]


def test_catalogue(spark):
    rows = spark.createDataFrame(
        [("a", datetime(2024, 1, 2), "f2"), ("a", datetime(2024, 1, 1), "f1")],
        "e STRING, timestamp TIMESTAMP_NTZ, file STRING")
    blank = {c: F.lit(None).cast("string") for c in ("gas", "source_doi", "citation")}
    events = catalog.provenance_events(rows.withColumns(blank), "e")
    assert sorted((r["file"], r["action"]) for r in events.collect()) == [
        ("f1", "create"), ("f2", "update")]
    again = catalog.provenance_events(rows.withColumns(blank), "e", events)
    assert {r["action"] for r in again.collect()} == {"update"}
    gone = catalog.tombstone("a", spark).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz"))
    facts = spark.createDataFrame([("a",), ("b",)], "k STRING")
    left = catalog.without_removed(facts, events.unionByName(gone), "k")
    assert [r["k"] for r in left.collect()] == ["b"]
    cites = spark.createDataFrame([({f"{p}{i}": str(i) for p in ["dataset_provider_citation_"]
                                     for i in (1, 2, 4)},)], "a MAP<STRING, STRING>")
    assert cites.select(catalog.citation_list("a")).first()[0] == ["1", "2"]


def test_grid_check(spark):
    g = spark.createDataFrame(
        [("a", 0.0, 0.1, 9.0, -0.1, 10, 10), ("b", 0.0, 0.1, 9.0, -0.1, 10, 10),
         ("c", 0.5, 0.1, 9.0, -0.1, 10, 10)],
        "f STRING, x0 DOUBLE, dx DOUBLE, y0 DOUBLE, dy DOUBLE, width INT, height INT")
    assert [r["f"] for r in joins.grid_mismatches(g, "f").collect()] == ["c"]


def test_gas_file_without_height(spark):
    from geoobs.functions import names

    files = ["ch4_arn_tower-insitu_478_allvalid-10magl.nc", "co_cmn_surface-insitu_443_allvalid.nc",
             "bad.nc"]
    df = spark.createDataFrame([(f,) for f in files], "f STRING").select(
        names.parse_gas_name("f").alias("p")).select("p.*")
    assert [(r["gas"], r["height"], r["station_id"]) for r in df.collect()] == [
        ("ch4", 10, "ARN10"), ("co", None, "CMN0"), (None, None, None)]
    assert S.GAS_SCALE["co2"][0] == 1e6


def test_tiles_of_one_day_in_two_batches(spark, tmp_path):
    from geoobs.streaming import ingest

    kind = "date DATE, tile_row INT, tile_col INT, file INT, data ARRAY<SMALLINT>"
    day = date(2020, 1, 1)
    first = spark.createDataFrame([(day, 0, 0, 2, [1]), (day, 0, 1, 1, [2])], kind)
    second = spark.createDataFrame([(day, 0, 1, 3, [3]), (day, 0, 2, 1, [4]), (day, 0, 0, 1, [9])], kind)
    for n, order in enumerate([(first, second), (second, first), (first, second, first)]):
        write = ingest.append_days(str(tmp_path / f"t{n}"))
        for k, batch in enumerate(order):
            write(batch, k)
        stored = spark.read.parquet(str(tmp_path / f"t{n}")).collect()
        assert sorted((r["tile_col"], r["data"]) for r in stored) == [(0, [1]), (1, [3]), (2, [4])]


def test_files_of_one_station_in_two_batches(spark, tmp_path):
    kind = "gas STRING, station_id INT, time INT, value INT, source_file STRING"
    a = spark.createDataFrame([("co2", 1, 1, 1, "a"), (None, 1, 2, 1, "a")], kind)
    b = spark.createDataFrame([("co2", 1, 3, 1, "b"), ("ch4", 2, 3, 1, "b")], kind)
    again = spark.createDataFrame([("co2", 1, 1, 7, "a")], kind)
    for n, order in enumerate([(a, b, again), (b, a, again, again)]):
        for batch in order:
            sinks.write_gas(batch, str(tmp_path / f"g{n}"))
        stored = sinks.gas_store(str(tmp_path / f"g{n}")).read(spark).collect()
        got = sorted((r["time"], r["value"], r["source_file"]) for r in stored)
        # The row without a gas came in the file that the last batch brings without it.
        assert got == [(1, 7, "a"), (3, 1, "b"), (3, 1, "b")]


def test_documents_are_stored_once(spark, tmp_path):
    docs = spark.createDataFrame([("ab" * 32, "{}"), ("cd" * 32, "{}")], "sha256 STRING, document STRING")
    for _ in range(2):
        sinks.write_passports(docs, str(tmp_path / "p"))
    assert spark.read.json(str(tmp_path / "p")).count() == 2


def test_header_of_the_first_lines_only(spark, tmp_path):
    (tmp_path / "w.csv").write_text("\nTIMESTAMP_START,TIMESTAMP_END,\nNEE\n\n1,2,3\nnote,x,y\n4,5,6\n")
    (tmp_path / "s.csv").write_text("TIMESTAMP,NEE\n1,2\nend of file\n")
    got = {r["path"].rsplit("/", 1)[1]: r["columns"]
           for r in flux_csv.headers(spark, [str(tmp_path / "w.csv"), str(tmp_path / "s.csv")]).collect()}
    assert got == {"w.csv": ["TIMESTAMP_START", "TIMESTAMP_END", "NEE"], "s.csv": ["TIMESTAMP", "NEE"]}


def test_unparsed_gas_files_are_reported(spark):
    rows = spark.createDataFrame([("what.nc", 1.0), ("what.nc", 2.0)], "file_name STRING, value DOUBLE")
    got = gas.unparsed_files(rows).first()
    assert (got["file"], got["status"], got["n_rows"]) == ("what.nc", "skipped", 2)


def test_more_than_fifty_citations(spark):
    names = {f"dataset_provider_citation_{i}": str(i) for i in range(1, 71)}
    df = spark.createDataFrame([(names,), ({},), (None,)], "a MAP<STRING, STRING>")
    got = [r[0] for r in df.select(catalog.citation_list("a")).collect()]
    assert got[0] == [str(i) for i in range(1, 71)] and got[1] == []


def test_removed_rows_stay_removed(spark):
    facts = spark.createDataFrame([("a", 1), ("a", 5), ("b", 1)], "k STRING, stored_at INT")
    events = spark.createDataFrame(
        [("a", "create", 1), ("a", "remove", 3), ("a", "update", 5), ("b", "create", 1)],
        "entity STRING, action STRING, timestamp INT")
    left = catalog.without_removed(facts, events, "k", "stored_at")
    assert sorted(map(tuple, left.collect())) == [("a", 5), ("b", 1)]


def test_alike_events_create_once(spark):
    rows = spark.createDataFrame(
        [("a", 1, "f", "co2", "d", "c"), ("a", 1, "f", "co2", "d", "c"), ("a", 1, "g", None, None, None)],
        "e STRING, timestamp INT, file STRING, gas STRING, source_doi STRING, citation STRING")
    actions = [r["action"] for r in catalog.provenance_events(rows, "e").collect()]
    assert sorted(actions) == ["create", "update", "update"]


def test_ocean_file_to_facts(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "// note, with a comma\nDate/Time,Longitude,Latitude,Temp [degC],Temp [degC] QC Flag,"
        "\"Odd, label\",Temp [degC] QC Comment\n"
        "2020-01-01T00:00:00Z,1.5,2.5,10.5,2,\"3\",\"a, \"\"b\"\"\"\n\n"
        "bad,1,2,11,3,4,x\n2020-01-02 00:00:00,,2,n/a\n".replace("Date/Time", "TIMESTAMP"))
    files = spark.read.text(str(tmp_path / "a.csv"), wholetext=True).select(
        F.lit("a").alias("file"), F.col("value").alias("text"))
    rows = ocean_csv.file_rows(files, "file", "text")
    assert rows.count() == 6
    got = sorted((str(r["time"]), r["variable"], r["value"], r["qc"], r["lon"], r["lat"])
                 for r in ocean_csv.good_times(rows, "stamp").collect())
    assert got == [
        ("2020-01-01 00:00:00", "Odd_label", 3.0, -1, 1.5, 2.5),
        ("2020-01-01 00:00:00", "Temp", 10.5, 2, 1.5, 2.5),
        ("2020-01-02 00:00:00", "Odd_label", None, -1, None, 2.0),
        ("2020-01-02 00:00:00", "Temp", None, -1, None, 2.0)]
    assert ocean_csv.file_rows(files.limit(0), "file", "text").count() == 0
