from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from geoobs.operators import aggregates, blocks, percentiles, spectral, windows

FIRST = "2021-01-01 00:00:00"


def _grid(spark, values, name="s", freq="h"):
    index = pd.date_range("2021-01-01", periods=len(values), freq=freq)
    rows = [(name, t.to_pydatetime(), None if np.isnan(v) else float(v))
            for t, v in zip(index, values)]
    return index, spark.createDataFrame(rows, "s STRING, t TIMESTAMP_NTZ, v DOUBLE")


def _values(df, col, ts="t"):
    return np.array([np.nan if r[0] is None else r[0] for r in
                     df.orderBy(ts).select(col).collect()], dtype=float)


@pytest.fixture(scope="module")
def gappy():
    rng = np.random.default_rng(1)
    v = rng.normal(400, 5, 24 * 40)
    v[:3] = np.nan
    v[100:269] = np.nan  # 169 slots, one more than the limit
    v[400:568] = np.nan  # 168 slots
    v[600:620] = np.nan
    v[-5:] = np.nan
    return v


def test_interpolation_matches_pandas(spark, gappy):
    index, df = _grid(spark, gappy)
    want = pd.Series(gappy, index).interpolate("time", limit=168, limit_area="inside")
    got = _values(windows.interpolate(df, "s", "t", "v", FIRST), "v")
    np.testing.assert_allclose(got, want.to_numpy(), rtol=1e-12)
    strict = _values(windows.interpolate(df, "s", "t", "v", FIRST, mode="whole_gap"), "v")
    assert np.isnan(strict[100:269]).all() and not np.isnan(strict[400:568]).any()


def test_gap_fill_pipeline_matches_pandas(spark, gappy):
    index, df = _grid(spark, gappy)
    s = pd.Series(gappy, index).interpolate("time", limit=168, limit_area="inside")
    s = s.fillna(s.groupby(index.dayofyear).transform("mean")).ffill().bfill()
    out = windows.assert_filled(windows.fill_gaps(df, "s", "t", "v", FIRST, "x"), "x")
    np.testing.assert_allclose(_values(out, "x"), s.to_numpy(), rtol=1e-12)


def test_unfilled_series_fails(spark, gappy):
    _, df = _grid(spark, gappy)
    with pytest.raises(Exception, match="missing values"):
        windows.assert_filled(df, "v").collect()


def test_rolling_means_match_pandas(spark, gappy):
    index, df = _grid(spark, gappy)
    want = pd.Series(gappy).rolling(24, center=True, min_periods=6).mean().to_numpy()
    np.testing.assert_allclose(_values(windows.rolling_day(df, "s", "t", "v"), "smooth"), want,
                               rtol=1e-12)
    days = np.arange(800.0)
    days[5] = np.nan
    _, daily = _grid(spark, days, freq="D")
    want = pd.Series(days).rolling(365, center=True, min_periods=1).mean().to_numpy()
    want[:182] = want[-182:] = np.nan
    out = windows.rolling_trend(daily, "s", "t", "v", FIRST, 800)
    np.testing.assert_allclose(_values(out, "trend"), want, rtol=1e-12)


@pytest.mark.parametrize("segment", [1, 7, 64])
def test_segments_do_not_show(spark, gappy, segment):
    """Gaps and frames reach over many segments; two series of different length share none."""
    _, one = _grid(spark, gappy[:500])
    _, two = _grid(spark, np.concatenate([[np.nan] * 300, gappy[300:420], [np.nan] * 200]), "z")
    df = one.unionByName(two)
    for mode in ("prefix", "whole_gap"):
        got, want = ([tuple(r) for r in windows.interpolate(
            df, "s", "t", "v", FIRST, mode=mode, **more).orderBy("s", "t").collect()]
            for more in ({"segment": segment}, {}))
        assert got == want
    got, want = ([tuple(r) for r in windows.fill_both_ways(
        df, "s", "t", "v", "x", **more).orderBy("s", "t").collect()]
        for more in ({"segment": segment}, {}))
    assert got == want and all(r[3] is not None for r in got)
    got, want = ([tuple(r) for r in windows.rolling_day(
        df, "s", "t", "v", **more).orderBy("s", "t").collect()]
        for more in ({"segment": segment}, {"segment": 10**6}))
    assert got == want


def test_series_without_any_value(spark):
    _, df = _grid(spark, np.full(50, np.nan))
    for out in (windows.interpolate(df, "s", "t", "v", FIRST, segment=8),
                windows.fill_both_ways(df, "s", "t", "v", segment=8),
                windows.rolling_day(df, "s", "t", "v", "v", segment=8)):
        assert out.count() == 50 and out.filter("v IS NOT NULL").isEmpty()


def test_minutes_of_half_a_year(spark):
    """A long series of fine slots: no window holds more than a segment and what its frames reach."""
    n = 60 * 24 * 180
    rng = np.random.default_rng(3)
    v = rng.normal(10, 2, n)
    v[rng.random(n) < 0.3] = np.nan
    v[70_000:90_000] = np.nan
    index = pd.date_range("2021-01-01", periods=n, freq="min")
    df = spark.createDataFrame(pd.DataFrame({"i": np.arange(n), "v": v})).select(
        F.lit("s").alias("s"), F.timestamp_add(
            "MINUTE", F.col("i").cast("int"), F.lit(FIRST).cast("timestamp_ntz")).alias("t"),
        F.when(~F.isnan("v"), F.col("v")).alias("v"))
    got = _values(windows.interpolate(df, "s", "t", "v", FIRST, seconds=60, limit=500), "v")
    want = pd.Series(v, index).interpolate("time", limit=500, limit_area="inside")
    np.testing.assert_allclose(got, want.to_numpy(), rtol=1e-9)
    smooth = windows.rolling_day(df, "s", "t", "v", width=240, seconds=60)
    want = pd.Series(v).rolling(240, center=True, min_periods=6).mean().to_numpy()
    np.testing.assert_allclose(_values(smooth, "smooth"), want, rtol=1e-9)
    keys = [line for line in smooth._jdf.queryExecution().executedPlan().toString().splitlines()
            if "Window [" in line]
    assert keys and all("_segment" in line for line in keys)


def test_best_window_prefers_summer(spark):
    # Winter is complete, July has 90 %: July wins for a threshold of 80 %.
    v = np.full(24 * 365, np.nan)
    v[: 24 * 20] = 1.0
    july = 24 * 185
    v[july:july + 24 * 10] = 1.0
    v[july:july + 24] = np.nan
    _, df = _grid(spark, v)
    out = windows.best_window(df, "s", "t", F.col("v").isNotNull(), FIRST, 365, 10).first()
    assert (str(out["start_day"])[:10], out["n_valid"]) == ("2021-07-05", 216)


def test_spectrum_matches_numpy(spark):
    n = 24 * 60
    i = np.arange(n)
    x = 400 + 0.01 * i + 3 * np.sin(2 * np.pi * i / 24) + np.cos(2 * np.pi * i / 12)
    _, df = _grid(spark, x)
    df = df.withColumn("i", windows.slot_number("t", FIRST, 3600))
    out = spectral.power_spectrum(df, "s", "i", "v").orderBy("f_per_day").toPandas()
    c = x - x.mean()
    c = (c - np.polyval(np.polyfit(i, c, 1), i)) * np.hanning(n)
    want = 2 * np.abs(np.fft.rfft(c)) ** 2 / (np.hanning(n) ** 2).sum() / 24
    np.testing.assert_allclose(out["power"], want[1:], rtol=1e-6, atol=1e-9)
    for m in (3, 97, 720):  # a tiny one, a prime length, a highly composite one
        part = spectral.power_spectrum(df.filter(F.col("i") < m), "s", "i", "v").orderBy("f_per_day")
        c = x[:m] - np.polyval(np.polyfit(i[:m], x[:m], 1), i[:m])
        fft = np.abs(np.fft.rfft(c * np.hanning(m))) ** 2
        got = part.toPandas()["power"].to_numpy()
        np.testing.assert_allclose(
            got, 2 * fft[1:] / (np.hanning(m) ** 2).sum() / 24, rtol=1e-6, atol=1e-9)
    one = spectral.power_at(df, "s", "i", "v", n, frequencies=[("daily", 1.0)]).first()
    np.testing.assert_allclose(one["power"], want[60], rtol=1e-6)
    bands = {r["band"]: r["band_power"] for r in spectral.band_power(
        spectral.power_spectrum(df, "s", "i", "v"), "s").collect()}
    assert bands["diurnal"] > 100 * bands["synoptic"]
    f = out["f_per_day"].to_numpy()
    edges = 10 ** np.linspace(np.log10(f.min()), np.log10(f.max()), 350)
    counts, _ = np.histogram(f, edges)
    bins = aggregates.log_bins(
        spectral.power_spectrum(df, "s", "i", "v"), ["s"], "f_per_day", "power")
    assert bins.agg(F.sum("n_freqs")).first()[0] == len(f)
    # Bin edges are powers of ten and may round to either side of a frequency that lies on one.
    assert abs(bins.count() - (counts > 0).sum()) <= 2


def test_percentiles_of_a_dominant_group(spark):
    rng = np.random.default_rng(2)
    big = rng.lognormal(0, 3, 20000)
    groups = {"big": big, "ties": np.repeat([1.0, 2.0], [7, 3]), "one": np.array([4.0]),
              "two": np.array([1.0, 2.0])}
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs]
    df = spark.createDataFrame(rows, "g STRING, x DOUBLE")
    q = {"a": 0.0, "b": 0.02, "c": 0.5, "d": 0.98, "e": 1.0}
    for bins, parts in ((64, 64), (4, 2), (1, 1)):
        out = percentiles.exact_percentiles(df, ["g"], "x", q, bins=bins, parts=parts)
        got = {r["g"]: [r[k] for k in q] for r in out.collect()}
        for g, xs in groups.items():
            np.testing.assert_allclose(got[g], np.percentile(xs, [0, 2, 50, 98, 100]), rtol=1e-12)
    flat = spark.createDataFrame([("f", 3.0)] * 5, "g STRING, x DOUBLE")
    assert tuple(percentiles.colour_bounds(flat, ["g"], "x").first())[1:] == (3.0, 4.0)


def test_positions_over_blocks(spark):
    t0 = pd.Timestamp("2021-01-01")
    rows = [("a", (t0 + pd.Timedelta(minutes=7 * (i // 2))).to_pydatetime(), i)
            for i in range(500)]
    rows += [("b", t0.to_pydatetime(), 0)]
    df = spark.createDataFrame(rows, "k STRING, t TIMESTAMP_NTZ, seq INT")
    out = blocks.with_position(df, ["k"], "t", ["seq"], total="n").filter("k = 'a'")
    assert out.filter("pos != seq OR n != 500").count() == 0
    prev = blocks.with_previous(df, ["k"], "t", ["seq"], {"seq": "p"})
    assert prev.filter("k = 'a' AND coalesce(p, -1) != seq - 1").count() == 0
    nxt = blocks.with_next(df, ["k"], "t", ["seq"], {"seq": "p"})
    assert nxt.filter("k = 'a' AND seq < 499 AND p != seq + 1").count() == 0
    assert nxt.filter("(k = 'b' OR seq = 499) AND p IS NOT NULL").count() == 0
    few = blocks.stride_sample(df, ["k"], "t", ["seq"], 100).filter("k = 'a'")
    assert sorted(r["seq"] for r in few.collect()) == list(range(0, 500, 5))


def test_line_breaks(spark):
    steps = [60] * 20 + [240] + [60] * 5 + [241] + [60] * 5
    t = pd.Timestamp("2021-01-01") + pd.to_timedelta(np.cumsum([0, *steps]), unit="s")
    df = spark.createDataFrame(
        [("a", x.to_pydatetime(), i) for i, x in enumerate(t)], "k STRING, t TIMESTAMP_NTZ, i INT")
    out = blocks.gap_flags(df, ["k"], "t", ["i"])
    assert [r["i"] for r in out.filter("line_break").collect()] == [27]


def test_null_keys_and_times_keep_their_rows(spark):
    from geoobs.operators import aggregates, blocks, percentiles

    rows = [("a", datetime(2024, 1, 1, h), 1.0 + h) for h in range(4)]
    rows += [(None, datetime(2024, 1, 1, h), 5.0 + h) for h in range(3)] + [("a", None, 9.0)]
    df = spark.createDataFrame(rows, "k STRING, ts TIMESTAMP_NTZ, v DOUBLE")
    placed = blocks.with_position(df, ["k"], "ts", ["v"], "pos", "total").collect()
    assert sorted((r["k"] or "", r["pos"], r["total"]) for r in placed) == sorted(
        [("a", i, 5) for i in range(5)] + [("", i, 3) for i in range(3)])
    assert [r["pos"] for r in placed if r["ts"] is None] == [4]  # rows without a time come last
    assert blocks.with_next(df, ["k"], "ts", ["v"], {"v": "next"}).count() == 8
    assert blocks.gap_flags(df, ["k"], "ts", ["v"]).count() == 8
    assert blocks.stride_sample(df, ["k"], "ts", ["v"]).count() == 8
    got = percentiles.exact_percentiles(df, ["k"], "v", {"p": 0.5}).collect()
    assert {(r["k"], r["p"]) for r in got} == {("a", 3.0), (None, 6.0)}
    assert percentiles.colour_bounds(df, ["k"], "v").count() == 2
    one = spark.createDataFrame([("a", 2.0, 3.0), (None, 1.0, 1.0), (None, 4.0, 1.0)],
                                "k STRING, f DOUBLE, p DOUBLE")
    bins = {(r["k"], r["bin"]) for r in aggregates.log_bins(one, ["k"], "f", "p").collect()}
    assert bins == {("a", 1), (None, 1), (None, 349)}


def test_narrow_below_the_int_range(spark):
    from geoobs.operators import reshape

    df = spark.createDataFrame([(-3e9,), (5.0,)], "v DOUBLE")
    assert reshape.narrow(df, ["v"]).dtypes == [("v", "bigint")]


@pytest.mark.parametrize("n", [3, 4, 97, 719, 720, 1021, 2048, 2053])
def test_spectrum_of_any_length_in_parts(spark, n):
    """Prime and composite lengths, by one task and folded with a chirp in three steps."""
    rng = np.random.default_rng(n)
    i = np.arange(n)
    x = rng.normal(size=n) + 5 * np.sin(i / 3) + 0.01 * i
    df = spark.createDataFrame(pd.DataFrame({"s": "a", "i": i, "v": x})).unionByName(
        spark.createDataFrame(pd.DataFrame({"s": "b", "i": i, "v": x[::-1].copy()})))
    c = x - np.polyval(np.polyfit(i, x, 1), i)
    w = np.hanning(n)
    want = (2 / 24 * np.abs(np.fft.rfft(c * w)) ** 2 / (w ** 2).sum())[1:n // 2 + 1]
    for whole in (spectral.WHOLE, 0):
        out = spectral.power_spectrum(df, "s", "i", "v", whole=whole)
        got = out.filter("s = 'a'").orderBy("f_per_day").toPandas()
        np.testing.assert_allclose(got["power"], want, rtol=1e-7, atol=1e-9 * want.max())
        np.testing.assert_allclose(got["f_per_day"], np.arange(1, n // 2 + 1) * 24 / n)
        assert out.filter("s = 'b'").count() == n // 2
