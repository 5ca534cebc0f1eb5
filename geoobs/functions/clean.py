"""Value, flag and time cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S

ColumnLike = Column | str


def _c(col: ColumnLike) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_value(col: ColumnLike) -> Column:
    """Numeric value or NULL for text, NaN and the -9999 sentinel in any spelling."""
    x = _c(col).try_cast("double")
    return F.when(~F.isnan(x) & (x != F.lit(S.MISSING_IN)), x)


def clean_qc(col: ColumnLike) -> Column:
    """Quality flag 0..3, rounded half to even; NULL when missing."""
    x = clean_value(col)
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(3.0), F.bround(x)))).cast(
        "tinyint"
    )


def ocean_qc(col: ColumnLike) -> Column:
    """Ocean flag as stored: unreadable flags become -1, fractions are cut off."""
    return F.coalesce(_c(col).try_cast("double").cast("tinyint"), F.lit(-1).cast("tinyint"))


def parse_flux_time(col: ColumnLike) -> Column:
    """Timestamp from yyyy, yyyyMM, yyyyMMdd or yyyyMMddHHmm, told apart by length."""
    s = F.trim(_c(col).cast("string"))
    n = F.length(s)
    parsed = (
        F.when(n >= 12, F.try_to_timestamp(F.substring(s, 1, 12), F.lit("yyyyMMddHHmm")))
        .when(n == 8, F.try_to_timestamp(s, F.lit("yyyyMMdd")))
        .when(n == 6, F.try_to_timestamp(s, F.lit("yyyyMM")))
        .when(n == 4, F.try_to_timestamp(s, F.lit("yyyy")))
    )
    return parsed.cast("timestamp_ntz")


def period_end(ts: ColumnLike, freq: ColumnLike) -> Column:
    """End of the averaging period that starts at ``ts``; month ends are clamped."""
    ts, freq = _c(ts), _c(freq)
    out = F.lit(None)
    for code, step in S.FREQ_OFFSETS.items():
        out = F.when(freq == code, ts + F.expr(step)).otherwise(out)
    return out


def micros(ts: ColumnLike) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session time zone."""
    return F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), _c(ts))


def cf_minutes(ts: ColumnLike, epoch: ColumnLike) -> Column:
    """Minutes since ``epoch`` as a double."""
    return (micros(ts) - micros(epoch)) / F.lit(60_000_000.0)


def cf_days(ts: ColumnLike) -> Column:
    """Whole days since 1970-01-01."""
    return F.datediff(_c(ts).cast("date"), F.lit("1970-01-01").cast("date"))


def cf_decode(value: ColumnLike, unit: str, origin: ColumnLike) -> Column:
    """Timestamp from a number counted in ``unit`` (days, hours, minutes, seconds) since ``origin``."""
    per = {"days": 86_400, "hours": 3_600, "minutes": 60, "seconds": 1}[unit]
    us = F.round(_c(value) * F.lit(float(per) * 1e6)).cast("bigint")
    return F.timestamp_add("MICROSECOND", us, _c(origin))


def joint_uncertainty(randunc: ColumnLike, p16: ColumnLike, p84: ColumnLike) -> Column:
    """sqrt(randunc^2 + ((p84 - p16) / 2)^2)."""
    half = (_c(p84) - _c(p16)) / 2
    return F.sqrt(_c(randunc) * _c(randunc) + half * half)


def envelope(value: ColumnLike, half_width: ColumnLike) -> tuple[Column, Column]:
    """Lower and upper bound of ``value`` minus/plus ``half_width``."""
    return _c(value) - _c(half_width), _c(value) + _c(half_width)


def clip01(col: ColumnLike) -> Column:
    """Value limited to [0, 1]; NULL stays NULL."""
    x = _c(col)
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))


def mask_range(value: ColumnLike, *flags: ColumnLike, low: int = 0, high: int = 2) -> Column:
    """``value`` where it is finite and every flag lies in low..high, else NULL.

    A flag column that is absent for a row is passed as -1 by the readers, so it fails the test.
    """
    x = _c(value)
    ok = x.isNotNull() & ~F.isnan(x)
    for flag in flags:
        ok = ok & _c(flag).between(low, high)
    return F.when(ok, x)


def mask_set(value: ColumnLike, flag: ColumnLike, keep: list[str]) -> Column:
    """``value`` where the flag is one of ``keep``, else NULL."""
    return F.when(_c(flag).isin(keep), _c(value))


def rescale_gas(value: ColumnLike, gas: ColumnLike, unit: ColumnLike | None = None) -> Column:
    """mol/mol to ppm or ppb by gas; with ``unit`` only rows in mol mol-1 are rescaled."""
    gas, value = _c(gas), _c(value)
    scale = F.lit(None).cast("double")
    for name, (factor, _) in S.GAS_SCALE.items():
        scale = F.when(gas == name, F.lit(factor)).otherwise(scale)
    if unit is None:
        return value * scale
    return F.when(_c(unit) == S.MOLE_FRACTION_UNIT, value * scale).otherwise(value)


def gas_unit(gas: ColumnLike) -> Column:
    """Unit after rescaling."""
    out = F.lit(None).cast("string")
    for name, (_, unit) in S.GAS_SCALE.items():
        out = F.when(_c(gas) == name, F.lit(unit)).otherwise(out)
    return out


def first_number(*cols: ColumnLike) -> Column:
    """First argument that reads as a number."""
    return F.coalesce(*[_c(c).try_cast("double") for c in cols])


def first_text(*cols: ColumnLike) -> Column:
    """First argument that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(_c(c).cast("string"), F.lit("")) for c in cols])


def hour_floor(ts: ColumnLike) -> Column:
    """Timestamp cut to the hour; rounding would merge half-hour stamps."""
    return slot_start(ts, "HOUR")


def slot_start(ts: ColumnLike, unit: str) -> Column:
    """Start of the calendar slot, without a zone (``date_trunc`` alone would add one)."""
    return F.date_trunc(unit, _c(ts)).cast("timestamp_ntz")


def is_night(ts: ColumnLike) -> Column:
    """True from 18:00 to 06:00."""
    h = F.hour(_c(ts))
    return (h >= 18) | (h < 6)


def season(ts: ColumnLike) -> Column:
    """DJF, MAM, JJA or SON."""
    m = F.month(_c(ts))
    return (
        F.when(m.isin(12, 1, 2), "DJF").when(m.between(3, 5), "MAM")
        .when(m.between(6, 8), "JJA").otherwise("SON")
    )


def export_fill(col: ColumnLike, dtype: str) -> Column:
    """NULL replaced by the fill value of an external array format."""
    fills = {"float": S.FILL_FLOAT, "double": S.FILL_FLOAT, "u1": 255, "tinyint": -1}
    return F.coalesce(_c(col), F.lit(fills.get(dtype, -9999)))
