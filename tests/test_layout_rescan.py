"""Layout by place and time, repeated scans of an inventory, and digest trees."""

import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from geoobs.operators import passport
from geoobs.sources import layout
from geoobs.streaming import rescan


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- layout --------------------------------------------------------------------------------------


def _places(spark, n=200_000):
    rng = np.random.default_rng(1)
    return spark.createDataFrame(pd.DataFrame({
        "deployment": rng.integers(0, 500, n), "lat": rng.uniform(-90, 90, n),
        "lon": rng.uniform(-180, 180, n), "s": rng.integers(0, 10 * 365 * 86_400, n),
        "value": rng.normal(size=n),
    })).withColumn("time", F.timestamp_add(
        "SECOND", F.col("s").cast("int"), F.expr("timestamp_ntz'2010-01-01 00:00:00'"))).drop("s")


def test_a_box_skips_most_row_groups(spark, tmp_path):
    df = _places(spark)
    layout.write_by_place(df, str(tmp_path / "z"), rows_per_file=25_000, rows_per_group=400)
    stored = spark.read.parquet(str(tmp_path / "z"))
    assert stored.schema["lat"].dataType == df.schema["lat"].dataType and stored.count() == 200_000
    period = F.col("time").between("2012-03-01", "2012-08-31")
    box = layout.in_box(stored, 40, 60, -20, 10).filter(period)
    want = layout.in_box(df, 40, 60, -20, 10).filter(period)
    assert box.count() == want.count() > 0
    assert "PushedFilters: [IsNotNull(lat)" in box._jdf.queryExecution().toString()
    read = groups = 0
    for path in Path(tmp_path / "z").glob("part-*"):
        meta = pq.ParquetFile(path).metadata
        at = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            s = {c: meta.row_group(g).column(at[c]).statistics for c in ("lat", "lon", "time")}
            groups += meta.row_group(g).num_rows
            if (s["lat"].max >= 40 and s["lat"].min <= 60 and s["lon"].max >= -20 and s["lon"].min <= 10
                    and s["time"].max >= pd.Timestamp("2012-03-01")
                    and s["time"].min <= pd.Timestamp("2012-08-31")):
                read += meta.row_group(g).num_rows
    assert groups == 200_000 and read < 0.2 * groups


def test_key_is_the_interleaved_bits(spark):
    rows = [(0.0, 0.0, 5.0), (-90.0, -180.0, 0.0), (90.0, 180.0, 10.0), (45.5, -20.25, 7.5),
            (None, 10.0, 3.0), (99.0, 500.0, -4.0)]
    df = spark.createDataFrame(rows, "lat DOUBLE, lon DOUBLE, t DOUBLE")
    got = [r[0] for r in df.select(layout.z_key(
        F.col("lat"), F.col("lon"), F.col("t"), F.lit(0.0), F.lit(10.0))).collect()]

    def cell(x, lo, hi):
        if x is None:
            return 0
        return int(min(max((x - lo) / (hi - lo), 0), 1) * ((1 << layout.BITS) - 1))

    for (lat, lon, t), key in zip(rows, got):
        cells = [cell(t, 0, 10), cell(lon, -180, 180), cell(lat, -90, 90)]
        assert key == sum((c >> b & 1) << 3 * b + k for b in range(layout.BITS)
                          for k, c in enumerate(cells))


def test_date_line_nulls_and_an_empty_table(spark, tmp_path):
    kind = "lat DOUBLE, lon DOUBLE, time TIMESTAMP_NTZ, v INT"
    rows = spark.createDataFrame(
        [(0.0, 179.0, None, 1), (0.0, -179.0, None, 2), (0.0, 0.0, None, 3), (None, None, None, 4)], kind)
    layout.write_by_place(rows, str(tmp_path / "a"))
    stored = spark.read.parquet(str(tmp_path / "a"))
    assert stored.count() == 4
    assert sorted(r.v for r in layout.in_box(stored, -1, 1, 170, -170).collect()) == [1, 2]
    layout.write_by_place(rows.filter("false"), str(tmp_path / "b"))
    assert spark.read.schema(kind).parquet(str(tmp_path / "b")).count() == 0


# --- rescans -------------------------------------------------------------------------------------


def test_changes_over_scans(spark, tmp_path):
    kind = "site STRING, kind STRING, n INT"
    listings = [
        [("a", "x", 1), ("b", "x", 1), (None, "x", 1)], [("a", "x", 1), ("c", None, 1), (None, "x", 2)],
        [("a", "x", 1), ("c", None, 1), (None, "x", 2), ("c", None, 1)], [], [("a", "x", None)],
    ]
    tick = spark.range(1)
    for i, rows in enumerate(listings):
        scan = rescan.scanner(lambda _, r=rows: spark.createDataFrame(r, kind), str(tmp_path / "s"),
                              ["site", "kind"], ["n"])
        for _ in range(1 + i % 2):  # a repeated scan reports nothing twice
            scan(tick, i)
    got = sorted(((r["scan"], r["change"], r["site"], r["kind"]) for r in
                  rescan.read_changes(spark, str(tmp_path / "s")).collect()), key=repr)
    assert got == sorted([
        (0, "added", "a", "x"), (0, "added", "b", "x"), (0, "added", None, "x"),
        (1, "removed", "b", "x"), (1, "added", "c", None), (1, "changed", None, "x"),
        (3, "removed", "a", "x"), (3, "removed", "c", None), (3, "removed", None, "x"),
        (4, "added", "a", "x")], key=repr)
    assert rescan.forget(spark, str(tmp_path / "s"), 4) == 4


# --- digest trees --------------------------------------------------------------------------------


def test_digest_trees(spark):
    some = random.Random(3)
    rows = [(f"s{i % 2}", f"a{i % 3}", _sha(str(some.randrange(300))), 5) for i in range(2000)]
    rows += [("s0", "a0", _sha("hot"), 1)] * 3000 + [(None, "a1", _sha("x"), 2)]
    kind = "store STRING, array_path STRING, sha256 STRING, size INT"
    df = spark.createDataFrame(rows, kind)
    columns = ["store"], "array_path", "sha256", "size"

    def plain(rows, digits):
        arrays = {}
        for store, array, sha, size in rows:
            arrays.setdefault((store, array), Counter())[sha] += 1
        out = {}
        for key, counts in arrays.items():
            ranges = {}
            for sha in sorted(counts):
                ranges.setdefault(sha[:digits], []).append(f"{sha}:{counts[sha]}")
            out[key] = _sha("\n".join(
                f"{r}:{_sha(chr(10).join(lines))}" for r, lines in sorted(ranges.items())))
        return out

    def roots(ranges):
        return {(r["store"], r["array_path"]): r["root_sha256"] for r in
                passport.root_digests(ranges, ["store"], "array_path").collect()}

    for digits in (1, 3):
        ranges = passport.range_digests(df, *columns, digits)
        assert roots(ranges) == plain(rows, digits)
    more = [("s0", "a0", _sha("hot"), 1), ("s0", "a0", _sha("new"), 1), ("s9", "new", _sha("1"), 1),
            (None, "a1", _sha("x"), 2)]
    ranges = passport.range_digests(df, *columns).cache()
    updated = passport.updated_ranges(ranges, df, spark.createDataFrame(more, kind), *columns)
    assert roots(updated) == plain(rows + more, 3)
    touched = updated.exceptAll(ranges).count()
    assert touched <= len(more)


def test_bounded_manifest_equals_the_stream(spark):
    rows = [("k", f"a{i % 2}", _sha(str(i % 7)), 3, i) for i in range(90)] + [(None, "a0", _sha("z"), 1, 1)]
    df = spark.createDataFrame(rows, "key STRING, array STRING, sha256 STRING, size INT, t INT")
    carry = {"t": "max"}
    a, b = (sorted((tuple(r) for r in f(df, ["key"], "array", "sha256", "size", carry).collect()), key=repr)
            for f in (passport.manifest, passport.bounded_manifest))
    assert a == b and len(a) == 3
