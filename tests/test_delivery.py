"""Delivery records: canonical text, the query log with extents, and whole documents of sessions."""

import hashlib
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from geoobs.operators import delivery, passport
from geoobs.plans import load, session_queries
from geoobs.plans.registry import Tables

SF = "/root/testdata/sf0.001"
LOG = ("session STRING, seq INT, op STRING, variable STRING, `group` STRING, payload STRING, "
       "surviving_stations ARRAY<STRING>")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("value", [
    {"b": 1, "a": {"z": [1, 2, {"y": None, "x": True}], "@id": "k"}}, [], {}, "plain",
    {"text": "é—ß 日本 🙂 \\ \" / \n\t <&>", "ключ": ["…"]}, [0, -1, 12345678901234567890, 1.5, -0.25],
])
def test_canonical_text(spark, value):
    given = json.dumps(value, ensure_ascii=False, indent=2)
    got = spark.createDataFrame([(given,)], "t STRING").select(passport.canonical_json(F.col("t")))
    assert got.first()[0] == json.dumps(value, sort_keys=True, separators=(",", ":"))


def test_canonical_text_of_null_and_of_no_json(spark):
    df = spark.createDataFrame([(None,), ("{",)], "t STRING")
    text = passport.canonical_json(F.col("t"))
    assert df.filter("t IS NULL").select(text).first()[0] is None
    with pytest.raises(Exception, match="(?i)malformed|json"):
        df.select(text).collect()


def test_payloads(spark):
    row = spark.range(1).select(F.lit("NEE").alias("v"), F.lit("g/é").alias("g"),
                                F.lit(None).cast("string").alias("none"))
    v, g, none = F.col("v"), F.col("g"), F.col("none")
    got = row.select(
        F.to_json(delivery.payload(variable=v, group=g, note=none)).alias("a"),
        F.to_json(delivery.slice_payload(v, g, "sel", "time", delivery.span(F.lit("2024"), none)))
        .alias("b"),
        F.to_json(delivery.slice_payload(none, none, "isel", "time", delivery.span(
            F.lit(3), F.lit(9), F.lit(2)))).alias("c"),
        F.to_json(delivery.where_payload(
            g, F.struct(F.struct(F.lit(2.5).alias("max"), F.lit(-1.0).alias("min")).alias("lat")),
            F.array(F.lit("A"), F.lit("B")), F.lit(False))).alias("d"),
        F.to_json(delivery.where_payload(
            g, F.lit(None).cast("struct<lat:struct<max:double,min:double>>"),
            F.lit(None).cast("array<string>"), F.lit(True), F.lit("x > 3"))).alias("e"),
    ).first()
    assert json.loads(got["a"]) == {"group": "g/é", "variable": "NEE"}
    assert got["b"] == ('{"group":"g/é","sel":{"time":{"start":"2024","step":null,"stop":null}},'
                        '"variable":"NEE"}')
    assert got["c"] == '{"isel":{"time":{"start":3,"step":2,"stop":9}}}'
    assert json.loads(got["d"]) == {
        "cond": {"lat": {"max": 2.5, "min": -1}}, "drop": False, "group": "g/é", "op": "where",
        "surviving_stations": ["A", "B"]}
    assert json.loads(got["e"]) == {
        "cond": {"repr": "x > 3"}, "drop": True, "group": "g/é", "op": "where"}


def _log(spark, rows):
    return spark.createDataFrame(rows, LOG).withColumn("payload", F.parse_json("payload"))


CANDIDATES = ("station STRING, site_name STRING, lat DOUBLE, lon DOUBLE, intake_height DOUBLE, country STRING, "
              "source_doi STRING, station_url STRING, citation STRING, dataset_name STRING")


def _candidates(spark):
    return spark.createDataFrame([
        ("A", "Åsite", 57.5, 12.0, 10.0, "SE", "doi:1", "http://a", "Cite A", "a.nc"),
        ("B", None, None, 12.0, None, "", "doi:1", None, "Cite B", "b.nc"),
        ("C", "C site", 1.25, -2.0, None, None, None, None, None, None),
        ("D", "D site", 0.0, 0.0, 0.0, "NO", "doi:2", "", "", ""),
    ], CANDIDATES)


def test_extents(spark):
    log = _log(spark, [
        ("s", 1, "where", None, "g", "{}", ["A", "C", "unknown"]), ("s", 2, "where", None, "g", "{}", ["x"]),
        ("s", 3, "where", None, "g", "{}", []), ("s", 4, "access", "v", "g", "{}", None),
        (None, 1, "where", None, "g", "{}", ["B"]),
    ])
    got = {(r["session"], r["seq"]): r["extent"] for r in delivery.with_extents(
        log, _candidates(spark), ["session"]).collect()}
    assert len(got) == 5
    e = got["s", 1]
    assert (e["lat"]["min"], e["lat"]["max"], e["lon"]["min"], e["lon"]["max"]) == (1.25, 57.5, -2, 12)
    assert got["s", 2] is got["s", 3] is got["s", 4] is None
    assert got[None, 1]["lat"]["min"] is None and got[None, 1]["lon"]["max"] == 12


def _passports(spark, *sessions):
    rows = [(s, "1.2.3.0/24", f"Title — {s}", [("g/NEE", 2, 20, sha("m"))]) for s in sessions]
    kind = ("session STRING, ip_anonymised STRING, name STRING, has_part ARRAY<STRUCT<id: STRING, "
            "chunk_count: BIGINT, size_bytes: BIGINT, manifest_sha256: STRING>>")
    return spark.createDataFrame(rows, kind).withColumns({
        "session_start": F.lit("2024-01-01T00:00:00Z"), "session_end": F.lit("2024-01-01T01:00:00Z"),
        "accessed_groups": F.array(F.lit("g")), "accessed_arrays": F.array(F.lit("NEE")),
        "total_bytes": F.lit(20).cast("bigint"), "total_chunks": F.lit(2).cast("bigint"),
        "is_part_of": F.lit(""), "citation": F.lit("Zitat: Ü"),
    })


def _documents(spark, passports, log):
    whole = delivery.deliveries(passports, log, _candidates(spark), "session", "icos:")
    docs = passport.graph_document(
        whole.withColumn("id", F.concat(F.lit("urn:"), "session")), "id", "icos:")
    return docs.select("session", "document", "sha256", passport.is_sound().alias("sound"))


def test_whole_documents(spark):
    log = _log(spark, [
        ("s", 1, "access", "NEE", "g", '{"variable":"NEE","group":"g"}', None),
        ("s", 2, "sel", "NEE", "g", '{"variable":"NEE","group":"g","sel":{"time":{"start":"2024","stop":null,"step":null}}}', None),
        ("s", 3, "where", "NEE", "g", '{"op":"where"}', ["C"]),
        ("s", 4, "where", "NEE", "g", '{"op":"where","drop":true}', ["D", "B", "A", "zz"]),
        ("s", 10, "user_recorded", None, "g", '{"op":"user_recorded","note":"größer"}', None),
        ("t", 1, "access", "GPP", "g", '{"variable":"GPP","group":"g"}', None),
    ])
    got = {r["session"]: r for r in _documents(spark, _passports(spark, "s", "t", "none"), log).collect()}
    assert sorted(got) == ["none", "s", "t"] and all(r["sound"] for r in got.values())
    docs = {s: json.loads(r["document"]) for s, r in got.items()}
    for s, r in got.items():
        assert r["document"].isascii()
        # The text is what sorted keys without blanks give, whoever writes it.
        assert r["document"] == json.dumps(docs[s], sort_keys=True, separators=(",", ":"))
        node = docs[s]["@graph"][1]
        assert node["passportSha256"] == r["sha256"]
        plain = {**docs[s], "@graph": [docs[s]["@graph"][0], {**node, "passportSha256": None},
                                       *docs[s]["@graph"][2:]]}
        assert sha(json.dumps(plain, sort_keys=True, separators=(",", ":"))) == r["sha256"]
    root, node, *entities = docs["s"]["@graph"]
    assert [q.get("op", "sel" if "sel" in q else "access") for q in node["query"]] == [
        "sel", "where", "where", "user_recorded"]
    assert node["stations"] == ["D", "B", "A", "zz"]
    assert [e["@id"] for e in entities] == ["#station/A", "#station/B", "#station/D", "doi:1", "doi:2"]
    assert [p["@id"] for p in node["hasPart"]] == ["g/NEE", *[e["@id"] for e in entities]]
    assert [p["@id"] for p in root["hasPart"]] == ["g/NEE"]
    a, b, d, first, second = entities
    assert a == {
        "@id": "#station/A", "@type": "icos:Station", "addressCountry": "SE", "identifier": "A",
        "geo": {"@type": "GeoCoordinates", "latitude": 57.5, "longitude": 12}, "intakeHeight": 10,
        "isBasedOn": {"@id": "doi:1"}, "name": "Åsite", "url": "http://a"}
    assert b == {"@id": "#station/B", "@type": "icos:Station", "identifier": "B", "name": "B", "url": "",
                 "isBasedOn": {"@id": "doi:1"}}
    assert d["geo"]["latitude"] == 0 and d["intakeHeight"] == 0
    assert first == {"@id": "doi:1", "@type": ["Dataset", "icos:DataObject"], "citation": "Cite A",
                     "name": "a.nc", "url": "doi:1"}
    assert second == {"@id": "doi:2", "@type": ["Dataset", "icos:DataObject"], "url": "doi:2"}
    assert docs["t"]["@graph"][1]["query"] == [{"group": "g", "variable": "GPP"}]
    assert docs["none"]["@graph"][1]["query"] == docs["none"]["@graph"][1]["stations"] == []


def test_changed_documents_are_not_sound(spark):
    docs = _documents(spark, _passports(spark, "s"), _log(spark, []))
    kept = docs.select("document", "sha256").first()
    changed = [kept["document"].replace("Title", "title"),
               kept["document"].replace(kept["sha256"], "0" * 64)]
    rows = [(kept["document"], kept["sha256"]), *[(t, kept["sha256"]) for t in changed]]
    got = spark.createDataFrame(rows, "document STRING, sha256 STRING").select(passport.is_sound())
    assert [r[0] for r in got.collect()] == [True, False, False]
    assert passport.verify(pd.Series([kept["document"]])).tolist() == [kept["sha256"]]


def test_a_logged_null_checksum_stays(spark):
    """Only the document's own checksum field is filled in."""
    log = _log(spark, [("s", 1, "user_recorded", None, "g", '{"passportSha256":null}', None)])
    row = _documents(spark, _passports(spark, "s"), log).first()
    assert json.loads(row["document"])["@graph"][1]["query"] == [{"passportSha256": None}]


def test_no_document_passes_through_python(spark):
    docs = load().QUERIES["passport_documents"](spark, SF)
    plan = docs._jdf.queryExecution().executedPlan().toString()
    after = plan[:plan.find("MapInPandas")]  # the manifest digests below are streamed in Python
    assert "Python" not in after and "EvalPython" not in plan


def test_log_of_the_registered_query(spark):
    log = session_queries._session_log(Tables(spark, SF))
    kinds = {r["op"] for r in log.select("op").distinct().collect()}
    assert kinds == {"access", "sel", "isel", "where", "user_recorded"}
    assert log.filter("payload IS NULL").isEmpty()
