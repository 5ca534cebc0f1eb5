"""Queries whose cost must not grow faster than their tables; every test lands its own rows."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from geoobs.operators import joins, passport, windows
from geoobs.plans import load, stream_queries
from geoobs.plans.registry import Tables
from geoobs.sources import sinks
from geoobs.streaming import ingest
from geoobs.streaming import sessions as stream_sessions

DAY = dt.timedelta(days=1)


def _land(spark, path, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _run(spark, path, name):
    return load().QUERIES[name](spark, path)


PART = "p_partkey bigint, p_name string, p_size int, p_retailprice double"
LINE = "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_shipdate timestamp_ntz"


def test_active_instruments_adds_up_before_it_joins(spark, tmp_path):
    first = dt.datetime(1995, 1, 1)
    # Two parts are mounted alike under one name, one is still open, one has no name.
    parts = [(1, "a", 4, 1.0), (1501 * 100 - 99, None, 1, 1.0), (301, "b", 1, 1.0), (301, "b", 1, 2.0)]
    lines = [(k, 1, 1, first + (k % 320) * DAY) for k in range(640)] + [(9999, 1, 1, None)]
    path = _land(spark, tmp_path, part=(parts, PART), lineitem=(lines, LINE))
    out = _run(spark, path, "active_instruments")
    plan = _plan(out)
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    expected = {}
    for key, name, size, _ in parts:
        start = first + (key % 1500) * DAY
        stop = start + size * 10 * DAY if size % 4 else None
        for _, _, number, at in lines:
            if at and key % 100 == 1 and size % 3 == number % 3 and at >= start and (
                    stop is None or at < stop):
                n, last = expected.get(name, (0, at))
                expected[name] = (n + 1, max(last, at))
    assert {r["instrument"]: (r["n"], r["last_used"]) for r in out.collect()} == expected
    assert expected["b"][0] == 40


def test_requests_meet_their_sessions_without_a_broadcast(spark):
    t0, idle = dt.datetime(2024, 1, 1), 300
    closed = [("c", "s", t0, t0 + dt.timedelta(seconds=700)),
              ("c", "s", t0 + dt.timedelta(seconds=1001), t0 + dt.timedelta(hours=5)),
              ("d", "s", t0, t0)]
    log = [(ip, "s", t0 + dt.timedelta(seconds=s), f"A/x/{s}")
           for ip in ("c", "d") for s in (0, 299, 300, 700, 701, 1000, 1001, 9000, 18000, 18001)]
    out = stream_sessions.chunks_of(
        spark.createDataFrame(closed, "ip string, store string, session_start timestamp, session_end timestamp"),
        spark.createDataFrame(log, "ip string, store string, ts timestamp, key string"), idle=idle)
    assert "BroadcastHashJoin" not in _plan(out)
    got = sorted((r["ip"], r["key"]) for r in out.collect())
    assert got == sorted((ip, key) for ip, _, at, key in log
                         if any(c == ip and a <= at <= b for c, _, a, b in closed))


def test_document_halves_are_written_once(spark):
    rows = spark.createDataFrame(
        [("u", "é — x", "2024", "2024", "n", [], ["\U0001f30d"], 1, 1, "", "", ['{"b":1.0,"a":"é"}'])],
        "id string, name string, session_start string, session_end string, ip_anonymised string, "
        "accessed_groups array<string>, accessed_arrays array<string>, total_bytes bigint, "
        "total_chunks bigint, is_part_of string, citation string, queries array<string>",
    ).withColumn("has_part", F.array(F.struct(
        F.lit("A/x").alias("id"), F.lit(1).alias("chunk_count"), F.lit(2).alias("size_bytes"),
        F.lit("0").alias("manifest_sha256"))))
    out = passport.graph_document(rows, "id")
    document, sha = out.select("document", "sha256").first()
    assert '"query":[{"a":"\\u00e9","b":1}]' in document and "\\ud83c\\udf0d" in document
    assert document.isascii() and passport.verify(pd.Series([document]))[0] == sha
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # Once as such and once for its length, not again where the text is escaped.
    assert plan.count("DataPassport") == 2


EVENT = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def test_slices_land_as_few_files(spark, monkeypatch):
    first = dt.datetime(2024, 1, 1)
    rows = [(k, first + dt.timedelta(minutes=k), 1, "view", 1.0, "") for k in range(12 * 1440)]
    df = spark.createDataFrame(rows, EVENT)
    names = lambda path: spark.read.schema(EVENT).parquet(path).select(
        "ts", F.col("_metadata.file_modification_time").alias("at"))
    day = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 86_400)
    one = names(stream_queries._land(df, day))
    assert one.select("at").distinct().count() == 12
    # With a smaller limit every slice is cut by time and its parts come in order.
    monkeypatch.setattr(stream_queries, "FILE_ROWS", 500)
    spans = names(stream_queries._land(df, day)).groupBy("at").agg(
        F.min("ts").alias("a"), F.max("ts").alias("b"), F.count("*").alias("n")).orderBy("at").collect()
    assert len(spans) == 36 and sum(r["n"] for r in spans) == len(rows)
    assert all(p["b"] < q["a"] for p, q in zip(spans, spans[1:]))


def test_streams_join_stations_without_a_broadcast(spark, tmp_path):
    first = dt.datetime(2024, 1, 1)
    rows = [(k, first + dt.timedelta(minutes=k), k % 3, "view", 1.0, "") for k in range(9)]
    customers = [(k, f"n{k}", 1, 1.0, "AUTO") for k in range(2)]
    path = _land(spark, tmp_path, events=(rows, EVENT), customer=(
        customers, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"))
    stream = stream_queries._gas_stream(Tables(spark, path), F.col("event_id") % 2)
    plans, counts = [], []

    def see(batch, _):
        plans.append(_plan(batch))
        counts.append(batch.count())

    ingest.start(stream, see, f"{tmp_path}/state").awaitTermination()
    assert sum(counts) == 6 and not any("BroadcastHashJoin" in p for p in plans)


def test_closing_sessions_of_many_clients_are_few_calls(spark, tmp_path):
    first = dt.datetime(2024, 1, 1)
    log = [(f"c{c}" if c else None, "s", first + dt.timedelta(seconds=s), c, "close" if s == 20 else "chunk")
           for c in range(50) for s in (0, 20, 40, 7000)]
    spark.createDataFrame(
        log, "ip string, store string, ts timestamp, size bigint, event string"
    ).write.parquet(f"{tmp_path}/log")
    stream = spark.readStream.schema(
        "ip string, store string, ts timestamp, size bigint, event string").parquet(f"{tmp_path}/log")
    out = ingest.run_to_table(stream_sessions.closing_sessions(stream, delay="1 minute", shares=4), "many")
    got = out.groupBy("ip").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("b")).collect()
    assert {r["ip"]: (r["n"], r["b"]) for r in got} == {
        f"c{c}" if c else None: (2, 2 * c) for c in range(50)}


def _days(spark, n, series=("a", "b", None)):
    first = dt.datetime(2000, 1, 1)
    rows = [(s, first + k * DAY, float(k % 7) / 3 + j) for j, s in enumerate(series) if j != 1
            for k in range(0, n, 5) if k % 100 < 60]
    obs = spark.createDataFrame(rows, "series string, day timestamp_ntz, value double")
    names = spark.createDataFrame([(s,) for s in series], "series string")
    last = first + (n - 1) * DAY
    grid = joins.reindex(
        joins.regular_grid(names, "series", str(first), str(last), "INTERVAL 1 DAY", "day"), obs,
        ["series", "day"])
    return obs, names, grid, str(first), str(last)


def _cells(df, name):
    return sorted(((r["series"] or "", r["day"], None if r[name] is None else round(r[name], 9))
                   for r in df.collect()), key=repr)


def test_rolling_trend_of_observations_is_that_of_their_grid(spark):
    obs, names, grid, first, _ = _days(spark, 700)
    for half, segment in ((3, 64), (20, 100), (182, 4096)):
        expected = windows.rolling_trend(grid, "series", "day", "value", first, 700, half=half)
        out = windows.rolling_trend_of(
            obs, names, "series", "day", "value", first, 700, half=half, segment=segment)
        assert _cells(out, "trend") == _cells(expected, "trend")
        assert "Window" not in _plan(out)


def test_interpolation_of_observations_is_that_of_their_grid(spark):
    obs, names, grid, first, last = _days(spark, 400)
    for mode, limit in (("prefix", 3), ("prefix", 168), ("whole_gap", 4)):
        expected = windows.interpolate(
            grid, "series", "day", "value", first, 86_400, limit, mode).select("series", "day", "value")
        out = windows.interpolate_of(obs, names, "series", "day", "value", first, last,
                                     "INTERVAL 1 DAY", 86_400, limit, mode, segment=50)
        assert _cells(out, "value") == _cells(expected, "value")


def test_queries_shuffle_observed_days_only(spark, tmp_path):
    first = dt.datetime(1995, 1, 1)
    orders = [(k, k % 200, 1.0, first + (k * 3) * DAY) for k in range(800)]
    path = _land(spark, tmp_path, orders=(
        orders, "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz"))
    out = _run(spark, path, "interpolate_168")
    plan = _plan(out)
    # The grid is generated above all exchanges but that of the sums.
    grid = "explode(sequence(coalesce"
    assert grid in plan and "Exchange" not in plan[:plan.index(grid)].split("HashAggregate")[-1]
    assert out.count() == 200


def test_passport_store_makes_its_documents_once(spark, tmp_path, monkeypatch):
    first = dt.datetime(2024, 1, 1)
    events = [(k, first + dt.timedelta(days=2 * k), k % 3, "view", 0.3, "") for k in range(9)]
    path = _land(spark, tmp_path, events=(events, EVENT), nation=(
        [(1, "x")], "n_nationkey int, n_name string"))
    plans, write = [], sinks.write_passports
    monkeypatch.setattr(sinks, "write_passports", lambda documents, to: (
        plans.append(documents._jdf.queryExecution().optimizedPlan().toString()), write(documents, to)))
    out = _run(spark, path, "passport_store").first()
    assert (out["n_documents"], out["n_sessions"]) == (9, 9)
    assert len(plans) == 2 and not any("Aggregate" in p for p in plans)
