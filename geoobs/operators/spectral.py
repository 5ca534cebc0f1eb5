"""Power spectra of gap-free gridded series."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from .keys import join_null_safe
from .windows import detrend_hann


# Slots up to which a series is transformed by one task.
WHOLE = 1 << 16


def _chirp(j: np.ndarray, n: int) -> np.ndarray:
    """``exp(-pi i j^2 / n)``; the square is taken modulo 2 n, so long series keep their precision."""
    return np.exp(-1j * np.pi * ((j * j) % (2 * n)) / n)


def _table(first: pa.Table, length: int, **columns) -> pa.Table:
    """Columns with the station and the lengths of a group's first row repeated beside them."""
    same = pa.array(np.zeros(length, dtype=np.int64))
    kept = {c: first[c].take(same) for c in ("station", "n", "n1")}
    return pa.table({**kept, **{c: pa.array(v) for c, v in columns.items()}})


def _first_step(rows: pa.Table) -> pa.Table:
    """A short series: its squares. Else the chirped slots of one offset, and those of the filter that
    they are folded with, transformed and turned by the phase of the offset."""
    n, n1, group = (rows[c][0].as_py() for c in ("n", "n1", "group"))
    slot, x = rows["i"].to_numpy(), rows["x"].to_numpy()
    if group < 0:
        series = np.zeros(n)
        series[slot] = x
        k = np.arange(1, n // 2 + 1)
        zero = np.zeros(len(k))
        square = np.abs(np.fft.fft(series)[k]) ** 2
        return _table(rows, len(k), group=np.full(len(k), -1), at=k, a_re=square, a_im=zero,
                      b_re=zero, b_im=zero)
    m = n1 * n1
    j = group + n1 * np.arange(n1)
    mine = np.zeros(n1, dtype=complex)
    mine[(slot - group) // n1] = x * _chirp(slot, n)
    near = np.minimum(j, m - j)
    fold = np.where(near < n, np.conj(_chirp(near, n)), 0)
    k1 = np.arange(n1)
    turn = np.exp(-2j * np.pi * ((k1 * group) % m) / m)
    a, b = np.fft.fft(mine) * turn, np.fft.fft(fold) * turn
    return _table(rows, n1, group=k1, at=np.full(n1, group), a_re=a.real, a_im=a.imag, b_re=b.real,
                  b_im=b.imag)


def _second_step(rows: pa.Table) -> pa.Table:
    """Every n1-th frequency of both, multiplied and transformed back over these frequencies."""
    if rows["group"][0].as_py() < 0:
        return rows.select(["station", "n", "n1", "group", "at"]).append_column(
            "re", rows["a_re"]).append_column("im", rows["a_im"])
    n1, k1 = rows["n1"][0].as_py(), rows["group"][0].as_py()
    order = np.argsort(rows["at"].to_numpy())
    a, b = (rows[f"{c}_re"].to_numpy()[order] + 1j * rows[f"{c}_im"].to_numpy()[order] for c in "ab")
    m = n1 * n1
    t0 = np.arange(n1)
    back = np.fft.ifft(np.fft.fft(a) * np.fft.fft(b)) * np.exp(2j * np.pi * ((k1 * t0) % m) / m)
    return _table(rows, n1, group=t0, at=np.full(n1, k1), re=back.real, im=back.imag)


def _third_step(rows: pa.Table) -> pa.Table:
    """Transformed back over the remainders: every n1-th frequency of the series."""
    n, n1, t0 = (rows[c][0].as_py() for c in ("n", "n1", "group"))
    if t0 < 0:
        return _table(rows, rows.num_rows, k=rows["at"].to_numpy(), square=rows["re"].to_numpy())
    order = np.argsort(rows["at"].to_numpy())
    found = np.fft.ifft(rows["re"].to_numpy()[order] + 1j * rows["im"].to_numpy()[order])
    k = t0 + n1 * np.arange(n1)
    keep = (k >= 1) & (k <= n // 2)
    return _table(rows, int(keep.sum()), k=k[keep], square=np.abs(found[keep]) ** 2)


def power_spectrum(
    df: DataFrame, station: str, slot: str, value: str, dt_hours: float = 1.0, whole: int = WHOLE
) -> DataFrame:
    """One-sided power density per station, frequencies and power per day.

    A complete series of up to ``whole`` slots is transformed by one task. A longer one of any length, a
    prime number too, is folded with a chirp instead, which needs transforms of a length of choice: the
    square of a power of two. Each of the three steps deals the series over as many tasks as that
    power, so none holds more than about twice the root of the series. Series below three slots have
    no spectrum.
    """
    i, v = F.col(slot).cast("bigint"), F.col(value).cast("double")
    fit = df.groupBy(station).agg(
        F.regr_slope(v, i).alias("_a"), F.regr_intercept(v, i).alias("_b"),
        F.count("*").alias("n"),
    ).filter("n >= 3")
    # The least power of two whose square holds the series twice.
    power = F.ceil(F.log2(F.sqrt(2.0 * F.col("n"))) - 1e-9)
    fit = fit.withColumn("n1", F.pow(F.lit(2.0), power).cast("bigint"))
    hann = 0.5 - 0.5 * F.cos(2 * F.pi() * i / (F.col("n") - 1))
    x = join_null_safe(df.select(station, slot, value), fit, [station]).select(
        F.col(station).alias("station"), "n", "n1", hann.alias("hann"),
        # Every offset of a folded series must have a slot, so the shortest are never folded.
        F.when(F.col("n") <= max(whole, 64), F.lit(-1)).otherwise(i % F.col("n1")).cast("bigint")
        .alias("group"), i.alias("i"),
        ((v - (F.col("_a") * i + F.col("_b"))) * hann).alias("x"),
    )
    kind = df.schema[station].dataType.simpleString()
    head = f"station {kind}, n bigint, n1 bigint"
    weight = x.groupBy("station").agg(F.sum(F.col("hann") * F.col("hann")).alias("_w"))
    first = x.drop("hann").groupBy("station", "group").applyInArrow(
        _first_step, f"{head}, group bigint, at bigint, a_re double, a_im double, b_re double, "
        "b_im double",
    )
    second = first.groupBy("station", "group").applyInArrow(
        _second_step, f"{head}, group bigint, at bigint, re double, im double")
    squares = second.groupBy("station", "group").applyInArrow(
        _third_step, f"{head}, k bigint, square double")
    return join_null_safe(squares, weight, ["station"]).select(
        F.col("station").alias(station),
        (F.col("k") * 24.0 / (F.col("n") * dt_hours)).alias("f_per_day"),
        (2 * dt_hours / 24 * F.col("square") / F.col("_w")).alias("power"),
    )


def power_at(
    df: DataFrame, station: str, slot: str, value: str, n: int, dt_hours: float = 1.0,
    frequencies=None,
) -> DataFrame:
    """Power density at listed frequencies (per day): one pass of sums, no Python, any length."""
    freqs = S.KEY_FREQUENCIES if frequencies is None else frequencies
    x = detrend_hann(df, station, slot, value, n)
    sums = [F.sum(F.col("hann") * F.col("hann")).alias("_w")]
    for i, (_, f) in enumerate(freqs):
        angle = F.col(slot) * F.lit(2 * math.pi * f * dt_hours / 24)
        sums += [
            F.sum(F.col("x") * F.cos(angle)).alias(f"_c{i}"),
            F.sum(F.col("x") * F.sin(angle)).alias(f"_s{i}"),
        ]
    agg = x.groupBy(station).agg(*sums)
    cells = [
        F.struct(
            F.lit(name).alias("frequency"), F.lit(float(f)).alias("f_per_day"),
            (2 * dt_hours / 24 * (F.pow(f"_c{i}", F.lit(2)) + F.pow(f"_s{i}", F.lit(2)))
             / F.col("_w")).alias("power"),
        )
        for i, (name, f) in enumerate(freqs)
    ]
    return agg.select(station, F.explode(F.array(*cells)).alias("_p")).select(station, "_p.*")


def band_power(spectrum: DataFrame, station: str, bands=None) -> DataFrame:
    """Share of the spectrum in each named band: mean density times band width."""
    bands = S.BANDS if bands is None else bands
    named = reduce(
        lambda acc, b: F.when(
            (F.col("f_per_day") >= b[1]) & (F.col("f_per_day") < b[2]), F.lit(b[0])
        ).otherwise(acc),
        bands, F.lit(None).cast("string"),
    )
    # Neighbouring frequencies of one series are evenly spaced.
    step = spectrum.groupBy(station).agg(F.min("f_per_day").alias("_df"))
    rows = join_null_safe(
        spectrum.withColumn("band", named).filter("band IS NOT NULL"), step, [station]
    )
    return rows.groupBy(station, "band").agg(
        F.sum(F.col("power") * F.col("_df")).alias("band_power"), F.count("*").alias("n_freqs")
    )
