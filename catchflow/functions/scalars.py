"""Scalar column builders: rounding, rescaling, dates, ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimals kept per variable of the analysis raster after post-processing.
ANALYSIS_DECIMALS = {
    "APCP_surface": 5,
    "DLWRF_surface": 4,
    "DSWRF_surface": 4,
    "PRES_surface": 3,
    "SPFH_2maboveground": 7,
    "TMP_2maboveground": 4,
    "UGRD_10maboveground": 4,
    "VGRD_10maboveground": 4,
}

EPOCH_1980 = "1980-01-01 00:00:00"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- rounding (M1, M2)

def round_decimals(c: Column | str, n: int) -> Column:
    """M1: half-to-even on the scaled value, ``rint(x * 10^n) / 10^n`` (what ``Series.round`` does)."""
    s = float(10 ** n)
    return F.rint(_c(c) * F.lit(s)) / F.lit(s)


def round_sigfigs(c: Column | str, n: int) -> Column:
    """M2: round to ``n`` significant figures; 0 and NULL unchanged."""
    x = _c(c)
    d = F.lit(n) - F.floor(F.log10(F.abs(x))) - 1
    pos = F.rint(x * F.pow(F.lit(10.0), d)) / F.pow(F.lit(10.0), d)
    neg = F.rint(x / F.pow(F.lit(10.0), -d)) * F.pow(F.lit(10.0), -d)
    return F.when(x.isNull() | (x == 0), x).when(d >= 0, pos).otherwise(neg)


def round_columns(df, spec: dict[str, int]):
    """M1 + P10: round each listed variable that exists in ``df``; other columns pass through."""
    return df.select(*[round_decimals(c, spec[c]).alias(c) if c in spec else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- rescaling (M3, M4)

def rescale(v: Column | str, lo: Column, hi: Column) -> Column:
    """M3: ``0.1 + 0.6 * (v - min) / (max - min)``; 1 when the frame is constant."""
    v = _c(v)
    return F.when(hi == lo, F.lit(1.0)).otherwise(F.lit(0.1) + F.lit(0.6) * (v - lo) / (hi - lo))


def power_norm(v: Column | str, lo: Column, hi: Column, gamma: float = 0.4) -> Column:
    """M4: ``((v - min) / (max - min)) ^ gamma``; NULL when the frame is constant."""
    return F.pow(F.try_divide(_c(v) - lo, hi - lo), F.lit(gamma))


# ---------------------------------------------------------------- dates

def water_year(t: Column | str) -> Column:
    """October starts the next water year."""
    t = _c(t)
    return (F.year(t) + (F.month(t) >= 10).cast("int")).cast("int")


def clamp_to_water_year(start: Column | str, hours: Column | int) -> Column:
    """P5: ``min(start + hours, 30 Sep 23:59:59 of the start's water year)``."""
    s = _c(start)
    h = F.lit(hours) if isinstance(hours, int) else hours
    end = F.timestamp_add("HOUR", h, s)
    wy_end = F.make_timestamp_ntz(water_year(s), F.lit(9), F.lit(30), F.lit(23), F.lit(59), F.lit(59))
    return F.least(end, wy_end)


def hours_since(n: Column | str, epoch: str = EPOCH_1980) -> Column:
    """D3: numeric hours since ``epoch`` -> timestamp_ntz."""
    return F.timestamp_add("HOUR", _c(n), F.lit(epoch).cast("timestamp_ntz"))


def parse_time(s: Column | str, fmt: str = "yyyy-MM-dd HH:mm:ss", strict: bool = True) -> Column:
    """Strict parse raises on a bad value (ANSI); lenient turns it into NULL."""
    s = _c(s)
    if strict:
        return F.to_timestamp_ntz(s, F.lit(fmt))
    return F.try_to_timestamp(s, F.lit(fmt)).cast("timestamp_ntz")


def time_from_name(path: Column | str) -> Column:
    """``yyyyMMdd_HHz`` inside a file name -> timestamp_ntz (NULL when absent)."""
    tok = F.regexp_extract(_c(path), r"(\d{8}_\d{2})z", 1)
    return F.when(tok != "", F.to_timestamp_ntz(tok, F.lit("yyyyMMdd_HH")))


def day_string(d: Column | str) -> Column:
    return F.date_format(_c(d), "yyyyMMdd")


def hour_string(h: Column | str) -> Column:
    return F.lpad(_c(h).cast("string"), 2, "0")


# ---------------------------------------------------------------- ids and names

def pad_gage(c: Column | str) -> Column:
    """A 7-character gage id lost its leading zero; only that length is padded."""
    c = _c(c)
    return F.when(F.length(c) == 7, F.concat(F.lit("0"), c)).otherwise(c)


def nex_id(c: Column | str) -> Column:
    """``nex-`` prefix."""
    return F.concat(F.lit("nex-"), _c(c).cast("string"))


def level_of(lv: Column | str) -> Column:
    """T5: ``level/variable`` -> level."""
    return F.split_part(_c(lv), F.lit("/"), F.lit(1))


def variable_of(lv: Column | str) -> Column:
    """T5: ``level/variable`` -> variable."""
    return F.split_part(_c(lv), F.lit("/"), F.lit(2))


def numeric_suffix(name: Column | str) -> Column:
    """The number before the extension, ``frame_12.png`` -> 12."""
    return F.regexp_extract(_c(name), r"_(\d+)\.", 1).cast("int")
