import hashlib
import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from geoobs.operators import passport, select, sessions, windows
from geoobs.streaming import ingest
from geoobs.streaming import sessions as stream_sessions

T0 = datetime(2024, 1, 1)
LOG = "seq INT, ts TIMESTAMP_NTZ, ip STRING, store STRING, key STRING, size BIGINT, " \
      "sha256 STRING, event STRING"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _log(spark, entries):
    """Entries are (seconds, ip, key, event)."""
    rows = [(i, T0 + timedelta(seconds=s), ip, "z", key, 10, _sha(key), event)
            for i, (s, ip, key, event) in enumerate(entries)]
    return spark.createDataFrame(rows, LOG)


def test_idle_limit_is_inclusive(spark):
    log = _log(spark, [(0, "a", "S/N/0", "chunk"), (299, "a", "S/N/1", "chunk"),
                       (599, "a", "S/N/2", "chunk"), (900, "a", "S/N/3", "chunk"),
                       (0, "b", "S/N/0", "chunk")])
    got = sorted((r["ip"], r["n_chunks"]) for r in sessions.sessions(log).collect())
    assert got == [("a", 1), ("a", 3), ("b", 1)]


def test_close_event(spark):
    log = _log(spark, [(0, "a", "S/N/0", "chunk"), (10, "a", "", "close"), (10, "a", "", "close"),
                       (20, "a", "S/N/1", "chunk"), (25, "a", "S/N/1", "chunk"),
                       (0, "b", "", "close")])
    got = sorted((r["ip"], r["n_chunks"], r["closed"]) for r in
                 sessions.sessions_with_close(log).collect())
    assert got == [("a", 1, True), ("a", 2, False)]


@pytest.fixture(scope="module")
def delivered(spark):
    return _log(spark, [
        (0, "1.2.3.4", "S1/NEE/0.0", "chunk"), (1, "1.2.3.4", "S1/NEE/0.1", "chunk"),
        (2, "1.2.3.4", "S1/NEE/0.0", "chunk"), (3, "1.2.3.4", "S1/dd/GPP/0", "chunk"),
        (4, "1.2.3.4", "S1/.zattrs", "chunk"), (5, "1.2.3.4", "NEE", "chunk"),
    ])


KEYS = ["ip", "store", "session_no"]


def test_manifest_counts_repeats(spark, delivered):
    chunks = sessions.with_session(sessions.tracked(delivered))
    for shuffled in (chunks, chunks.orderBy(F.desc("seq")).repartition(3)):
        m = {r["array_path"]: r for r in passport.manifest(
            shuffled, KEYS, "array_path", "sha256", "size").collect()}
        digests = sorted([_sha("S1/NEE/0.0"), _sha("S1/NEE/0.0"), _sha("S1/NEE/0.1")])
        assert m["S1/NEE"]["manifest_sha256"] == _sha("\n".join(digests))
        assert (m["S1/NEE"]["chunk_count"], m["S1/NEE"]["size_bytes"]) == (3, 30)
        assert set(m) == {"S1/NEE", "S1/dd/GPP", "NEE"}


def _documents(spark, delivered):
    chunks = sessions.with_session(sessions.tracked(delivered))
    provenance = spark.createDataFrame(
        [("S1", "https://doi.org/10.1/x", "Cité")], "group STRING, source_doi STRING, citation STRING")
    rows = passport.assemble(passport.detailed_manifest(chunks, KEYS), provenance, KEYS)
    rows = rows.withColumns({
        "id": F.lit("urn:x"), "stations": F.array(F.lit("SAC100")),
        "queries": F.array(F.lit('{"op":"where"}')), "entity_ids": F.array(F.lit("#station/SAC100")),
        "entities": F.array(F.lit('{"@id":"#station/SAC100"}')),
    })
    return passport.graph_document(rows, "id")


def test_passport_document(spark, delivered):
    row = _documents(spark, delivered).first()
    doc = json.loads(row["document"])
    node = doc["@graph"][1]
    assert node["passportSha256"] == row["sha256"]
    plain = {**doc, "@graph": [doc["@graph"][0], {**node, "passportSha256": None},
                               *doc["@graph"][2:]]}
    assert _sha(json.dumps(plain, sort_keys=True, separators=(",", ":"))) == row["sha256"]
    assert node["accessedGroups"] == ["S1", "S1/dd"]
    assert node["accessedArrays"] == ["GPP", "NEE"]
    assert node["totalChunks"] == 5 and node["totalBytesServed"] == 50
    assert node["name"] == "Data access passport — GPP, NEE (2024-01-01)"
    assert node["sessionEnd"] == "2024-01-01T00:00:05Z"
    assert node["agent"]["ipAnonymised"] == "1.2.3.0/24"
    assert node["isPartOf"] == {"@id": "https://doi.org/10.1/x"} and node["citation"] == "Cité"
    assert node["query"] == [{"op": "where"}]
    assert {p["@id"] for p in node["hasPart"]} == {
        "S1/NEE", "S1/dd/GPP", "NEE", "#station/SAC100"}
    assert len(doc["@graph"][0]["hasPart"]) == 3 and doc["@graph"][2]["@id"] == "#station/SAC100"
    import pandas as pd

    assert passport.verify(pd.Series([row["document"]])).tolist() == [row["sha256"]]


def test_passport_sink(spark, delivered, tmp_path):
    from geoobs.sources import sinks

    docs = _documents(spark, delivered)
    sinks.write_passports(docs, str(tmp_path / "p"))
    back = spark.read.json(str(tmp_path / "p")).first()
    assert back["file_name"] == docs.first()["sha256"][:16] + ".jsonld"


@pytest.mark.parametrize("steps, kept", [
    ([("access", "NEE")], 1), ([("access", "NEE"), ("isel", "NEE")], 1),
    ([("access", "NEE"), ("sel", "NEE")], 1),
    ([("access", "NEE"), ("isel", "NEE"), ("access", "GPP"), ("isel", "GPP")], 2),
    ([("access", "NEE"), ("isel", "NEE"), ("isel", "NEE")], 2),
    ([("access", "NEE"), ("access", "GPP"), ("isel", "GPP")], 2),
    ([("access", "NEE"), ("where", "NEE")], 2),
])
def test_query_log_compaction(spark, steps, kept):
    rows = [("s", i, op, v, "g") for i, (op, v) in enumerate(steps)]
    log = spark.createDataFrame(rows, "session STRING, seq INT, op STRING, variable STRING, `group` STRING")
    assert windows.compact_queries(log).count() == kept


def test_selection_log(spark):
    df = spark.createDataFrame(
        [("s1", datetime(2024, 1, d), "NEE", float(d)) for d in range(1, 11)],
        "station_id STRING, time TIMESTAMP_NTZ, variable STRING, value DOUBLE")
    ds = select.Selection(df, "g")
    part = ds["NEE"].sel(time=slice("2024-01-03", "2024-01-05"))
    assert part.df.count() == 3  # the end date is included
    assert ds["NEE"].isel(slice(0, 2)).df.count() == 2
    log = [json.loads(r["payload"]) for r in ds.query_log("x").orderBy("seq").collect()]
    assert log[1]["sel"]["time"] == {"start": "2024-01-03", "stop": "2024-01-05", "step": None}
    assert "op" not in log[0] and len(log) == 4
    masked = ds.where(F.col("value") > 9, "value > 9")
    assert masked.df.count() == 1
    kept = windows.last_surviving(ds.query_log("x"), "session", "seq", "surviving_stations").first()
    assert kept["surviving_stations"] == ["s1"]
    month = select.time_slice(df, "time", "2024", "2024-01")
    assert month.count() == 10


def _landed(spark, tmp_path, entries):
    folder = str(tmp_path / "log")
    log = _log(spark, entries).withColumn("ts", F.col("ts").cast("timestamp"))
    log.repartition(3).write.parquet(folder)
    return ingest.read_landing(spark, folder, log.schema)


def test_streamed_sessions(spark, tmp_path):
    entries = [(0, "a", "S/N/0", "chunk"), (300, "a", "S/N/0", "chunk"), (601, "a", "S/N/0", "chunk"),
               (5, "b", "S/N/0", "chunk"), (5000, "c", "S/N/0", "chunk")]
    stream = _landed(spark, tmp_path, entries)
    out = ingest.run_to_table(stream_sessions.closed_sessions(stream), "t-sessions")
    # The session of c is still open when the input ends.
    assert sorted((r["ip"], r["n_chunks"]) for r in out.collect()) == [("a", 1), ("a", 2), ("b", 1)]


def test_streamed_close(spark, tmp_path):
    entries = [(0, "a", "S/N/0", "chunk"), (10, "a", "", "close"), (20, "a", "S/N/0", "chunk"),
               (30, "a", "S/N/0", "chunk"), (400, "a", "S/N/0", "chunk"), (3, "b", "", "close"),
               (9000, "c", "S/N/0", "chunk")]
    stream = _landed(spark, tmp_path, entries)
    out = ingest.run_to_table(stream_sessions.closing_sessions(stream), "t-closing")
    assert sorted((r["ip"], r["n_chunks"], r["ended_by"]) for r in out.collect()) == [
        ("a", 1, "close"), ("a", 1, "idle"), ("a", 2, "idle")]


def _batches(spark, folder, parts):
    """One file for each part, later parts with later file times."""
    for part in parts:
        log = _log(spark, part).withColumn("ts", F.col("ts").cast("timestamp"))
        log.coalesce(1).write.mode("append").parquet(folder)
    return ingest.read_landing(spark, folder, log.schema, maxFilesPerTrigger="1")


def test_closing_sessions_over_micro_batches(spark, tmp_path):
    late = [
        [(4000, "a", "S/N/0", "chunk"), (50, "b", "S/N/0", "chunk")],
        [(3900, "a", "S/N/0", "chunk"), (5000, "a", "S/N/0", "chunk"), (100, "b", "", "close")],
        [(4950, "a", "", "close"), (4900, "a", "S/N/0", "chunk"), (5100, "a", "S/N/0", "chunk")],
        [(20000, "z", "S/N/0", "chunk")],
    ]
    whole = [[e for part in late for e in part]]
    # Requests of 4900 and 5000 are one pause apart, but the close between them ends the first.
    want = [("a", 1, "close"), ("a", 2, "idle"), ("a", 2, "idle"), ("b", 1, "close")]
    for n, parts in enumerate([late, late[2::-1] + late[3:], whole]):
        stream = _batches(spark, str(tmp_path / f"log{n}"), parts)
        out = ingest.run_to_table(
            stream_sessions.closing_sessions(stream, delay="2 hours"), f"t-close-{n}")
        got = sorted((r["ip"], r["n_chunks"], r["ended_by"]) for r in out.collect())
        assert got == want, n


def test_session_of_a_client_without_address(spark):
    log = _log(spark, [(0, "a", "S/N/0", "chunk"), (1, None, "S/N/0", "chunk")])
    assert sessions.with_session(log).count() == 2


def test_query_log_with_holes(spark):
    log = spark.createDataFrame(
        [("x", 0, "access", "v", "g"), ("x", 5, "sel", "v", "g"), ("x", 9, "access", "v", "g"),
         ("x", 90_000, "isel", "v", "g"), (None, 1, "access", "v", "g")],
        "session STRING, seq BIGINT, op STRING, variable STRING, `group` STRING")
    got = sorted((r["session"] or "", r["seq"]) for r in windows.compact_queries(log).collect())
    assert got == [("", 1), ("x", 5), ("x", 90_000)]


def test_two_origins_of_a_group_count_once(spark):
    rows = _log(spark, [(0, "a", "S/N/0", "chunk"), (1, "a", "S/N/1", "chunk")])
    keys = ["ip", "store", "session_no"]
    manifest = passport.detailed_manifest(
        sessions.with_session(sessions.tracked(rows)), keys, "ts")
    origins = spark.createDataFrame([("S", "d1", "c1"), ("S", "d2", "c2")],
                                    "`group` STRING, source_doi STRING, citation STRING")
    got = passport.assemble(manifest, origins, keys).first()
    assert (got["total_chunks"], got["is_part_of"]) == (2, "d1")


def test_late_rows_are_counted(spark, tmp_path):
    parts = [[(9000, "a", "S/N/0", "chunk")], [(9001, "b", "S/N/0", "chunk")],
             [(10, "c", "S/N/0", "chunk"), (20, "d", "S/N/0", "chunk")],
             [(90000, "e", "S/N/0", "chunk")]]
    stream, report = _batches(spark, str(tmp_path / "log"), parts), []
    out = ingest.run_to_table(stream_sessions.closed_sessions(stream), "t-late", report)
    assert sorted(r["ip"] for r in out.collect()) == ["a", "b"]
    assert report == [("skipped", "later than the watermark", 2)]


def test_selection_positions_masks_and_extents(spark):
    rows = [(s, datetime(2024, 1, 1 + d), "NEE", float(d), 50.0 + d)
            for s in ("s1", "s2") for d in range(10)]
    df = spark.createDataFrame(
        rows, "station_id STRING, time TIMESTAMP_NTZ, variable STRING, value DOUBLE, lat DOUBLE")
    ds = select.Selection(df, "flux", keys=["station_id"])
    days = lambda s: sorted({r["time"].day for r in s.df.collect()})
    assert days(ds.isel(-1)) == [10] and days(ds.isel(3)) == [4]
    assert days(ds.isel(slice(-4, -1))) == [7, 8, 9]
    assert days(ds.isel(slice(1, None, 4))) == [2, 6, 10]
    long = "value > 6 " + "and value > 6 " * 60
    masked = ds.where(F.col("value") > 6, long, extent=("time", "lat"), drop=False)
    assert masked.df.count() == 20 and masked.df.agg(F.count("value")).first()[0] == 6
    entry = json.loads(ds.query_log("x").orderBy(F.desc("seq")).first()["payload"])
    assert entry["cond"]["repr"] == long and entry["drop"] is False
    assert entry["cond"]["extent"] == {
        "time": ["2024-01-08 00:00:00", "2024-01-10 00:00:00"], "lat": ["57.0", "59.0"]}
