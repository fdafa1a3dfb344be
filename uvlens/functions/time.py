"""Time buckets as column expressions over epoch-millisecond columns.

All functions take the *SQL text* of their input (usually a column name) and
return a ``Column``. They never depend on the session time zone: everything is
arithmetic on ``TIMESTAMP_NTZ``, dates and intervals, and zones go through
``convert_timezone``, which is zone-explicit. ``timestampdiff``, ``date_trunc`` and
``date_format`` are avoided on ``TIMESTAMP_NTZ``: they cast it to an instant of the
session zone, which moves wall-clock times that this zone skips. The stored test
timestamps are UTC wall-clock times.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

UNIT_MS = {
    "second": 1_000,
    "minute": 60_000,
    "hour": 3_600_000,
    "day": 86_400_000,
}


def _q(zone: str) -> str:
    return zone.replace("'", "")


# --- epoch ms <-> timestamps -------------------------------------------------

def epoch_ms_sql(ts: str) -> str:
    """Epoch ms of a TIMESTAMP_NTZ taken as UTC (floor, not rounding)."""
    # counted from the year 1, so that the truncating division is a floor
    return (f"((({ts}) - TIMESTAMP_NTZ'0001-01-01 00:00:00') div INTERVAL '0.001' SECOND"
            " - 62135596800000)")


def epoch_ms(ts: str) -> Column:
    return F.expr(epoch_ms_sql(ts))


def local_ts_sql(ms: str, zone: str = "UTC") -> str:
    """Wall-clock TIMESTAMP_NTZ of epoch ms in ``zone``."""
    utc = f"({EPOCH} + INTERVAL '0.001' SECOND * ({ms}))"
    if zone.upper() == "UTC":
        return utc
    return f"convert_timezone('UTC', '{_q(zone)}', {utc})"


def local_ts(ms: str, zone: str = "UTC") -> Column:
    return F.expr(local_ts_sql(ms, zone))


def local_to_ms_sql(ntz: str, zone: str = "UTC") -> str:
    """Epoch ms of a wall-clock TIMESTAMP_NTZ read in ``zone``."""
    if zone.upper() == "UTC":
        return epoch_ms_sql(ntz)
    return epoch_ms_sql(f"convert_timezone('{_q(zone)}', 'UTC', {ntz})")


def event_time(ms: str) -> Column:
    """TIMESTAMP (instant) for windows and watermarks."""
    return F.expr(f"timestamp_millis({ms})")


# --- fixed-width, epoch-aligned buckets (T1, B1, B2) ---------------------------

def floor_ms_sql(ms: str, width_ms: int) -> str:
    return f"({ms} - pmod({ms}, {int(width_ms)}))"


def floor_ms(ms: str, width_ms: int) -> Column:
    return F.expr(floor_ms_sql(ms, width_ms))


def window_end_ms(ms: str, width_ms: int) -> Column:
    """Label of an epoch-aligned tumbling window: its end (exclusive)."""
    return F.expr(f"({floor_ms_sql(ms, width_ms)} + {int(width_ms)})")


def hour_start(ms: str) -> Column:
    """Start of the UTC hour (B1)."""
    return floor_ms(ms, UNIT_MS["hour"])


def hour_end(ms: str) -> Column:
    """Last millisecond of the UTC hour (B6, in ms)."""
    return F.expr(f"({floor_ms_sql(ms, UNIT_MS['hour'])} + {UNIT_MS['hour'] - 1})")


def minute_start(ms: str) -> Column:
    return floor_ms(ms, UNIT_MS["minute"])


# --- calendar buckets in a zone (B5, B7, B8, B9) ------------------------------

CALENDAR_UNITS = ("MINUTE", "HOUR", "DAY", "WEEK", "MONTH", "QUARTER", "YEAR")


def trunc_local_sql(unit: str, local: str) -> str:
    """Start of the calendar unit of a wall-clock TIMESTAMP_NTZ."""
    day = f"cast(cast({local} as date) as timestamp_ntz)"
    if unit == "DAY":
        return day
    if unit == "HOUR":
        return f"({day} + INTERVAL '1' HOUR * hour({local}))"
    if unit == "MINUTE":
        return f"({day} + INTERVAL '1' MINUTE * (hour({local}) * 60 + minute({local})))"
    return f"cast(trunc(cast({local} as date), '{unit}') as timestamp_ntz)"


def add_local_sql(unit: str, n: int, local: str) -> str:
    """A wall-clock TIMESTAMP_NTZ moved by ``n`` units."""
    unit, n = unit.upper(), int(n)
    if unit == "MILLISECOND":
        return f"({local} + INTERVAL '0.001' SECOND * {n})"
    if unit == "WEEK":
        unit, n = "DAY", 7 * n
    if unit == "QUARTER":
        unit, n = "MONTH", 3 * n
    if unit not in ("SECOND", "MINUTE", "HOUR", "DAY", "MONTH", "YEAR"):
        raise ValueError(f"unknown unit {unit}")
    return f"({local} + INTERVAL '1' {unit} * ({n}))"


def calendar_start_sql(ms: str, unit: str, zone: str = "UTC") -> str:
    unit = unit.upper()
    if unit not in CALENDAR_UNITS:
        raise ValueError(f"unit must be one of {CALENDAR_UNITS}")
    # WEEK truncates to the ISO Monday.
    return local_to_ms_sql(trunc_local_sql(unit, local_ts_sql(ms, zone)), zone)


def calendar_start(ms: str, unit: str, zone: str = "UTC") -> Column:
    return F.expr(calendar_start_sql(ms, unit, zone))


def calendar_end(ms: str, unit: str, zone: str = "UTC") -> Column:
    """Last millisecond of the calendar bucket (start of the next one - 1)."""
    unit = unit.upper()
    nxt = add_local_sql(unit, 1, trunc_local_sql(unit, local_ts_sql(ms, zone)))
    return F.expr(f"({local_to_ms_sql(nxt, zone)} - 1)")


def day_of_year(ms: str, zone: str = "UTC") -> Column:
    return F.expr(f"dayofyear({local_ts_sql(ms, zone)})")


def month_of_year(ms: str, zone: str = "UTC") -> Column:
    return F.expr(f"month({local_ts_sql(ms, zone)})")


def year_of(ms: str, zone: str = "UTC") -> Column:
    return F.expr(f"year({local_ts_sql(ms, zone)})")


def month_start_of(year: str, month: str, zone: str = "UTC") -> Column:
    """Epoch ms of local midnight on the first day of (year, month)."""
    ntz = f"cast(make_date({year}, {month}, 1) as timestamp_ntz)"
    return F.expr(local_to_ms_sql(ntz, zone))


def month_end_of(year: str, month: str, zone: str = "UTC") -> Column:
    """Last millisecond of (year, month) in local time."""
    nxt = add_local_sql("MONTH", 1, f"cast(make_date({year}, {month}, 1) as timestamp_ntz)")
    return F.expr(f"({local_to_ms_sql(nxt, zone)} - 1)")


def year_start_of(year: str, zone: str = "UTC") -> Column:
    return month_start_of(year, "1", zone)


def day_list(ms1: str, ms2: str, zone: str = "UTC") -> Column:
    """Local days from ``ms1`` to ``ms2`` inclusive as 'yyyy-MM-dd' texts;
    empty when the range is reversed (``sequence`` would count down)."""
    d1 = f"cast({local_ts_sql(ms1, zone)} as date)"
    d2 = f"cast({local_ts_sql(ms2, zone)} as date)"
    return F.expr(f"CASE WHEN {d1} <= {d2} THEN transform(sequence({d1}, {d2}), "
                  f"d -> cast(d as string)) ELSE cast(array() AS array<string>) END")


def parse_ms(text: str, pattern: str, zone: str = "UTC") -> Column:
    """Text in ``pattern`` read as wall-clock time in ``zone`` -> epoch ms;
    null when the text does not fit. The parse itself carries an explicit
    offset, so it never depends on the session time zone."""
    wall = f"unix_millis(try_to_timestamp(concat({text}, ' +0000'), '{pattern} Z'))"
    if zone.upper() == "UTC":
        return F.expr(wall)
    return F.expr(local_to_ms_sql(local_ts_sql(wall), zone))


def day_time(year: str, day_index: str, zone: str = "UTC") -> Column:
    """Epoch ms of local midnight of day ``day_index`` (1-based) of ``year``."""
    ntz = (f"cast(date_add(make_date({year}, 1, 1), cast({day_index} - 1 as int))"
           " as timestamp_ntz)")
    return F.expr(local_to_ms_sql(ntz, zone))


# --- year-anchored batch time (B3, B4) ----------------------------------------

def batch_time_sql(ms: str, n: int, unit: str, zone: str = "UTC") -> str:
    """Bucket start counted from the start of the local year.

    seconds / minutes / hours: ``ys + floor((ms - ys) / d) * d``;
    days: blocks of ``n`` days from January 1, restarting every year.
    """
    unit = unit.lower().rstrip("s")
    n = int(n)
    if n <= 0:
        raise ValueError("n must be positive")
    local = local_ts_sql(ms, zone)
    year_start = local_to_ms_sql(trunc_local_sql("YEAR", local), zone)
    if unit in ("second", "minute", "hour"):
        d = n * UNIT_MS[unit]
        return f"({year_start} + (({ms} - {year_start}) div {d}) * {d})"
    if unit == "day":
        start_day = (f"cast(date_add(trunc(cast({local} as date), 'YEAR'), "
                     f"cast(((dayofyear({local}) - 1) div {n}) * {n} as int)) as timestamp_ntz)")
        return local_to_ms_sql(start_day, zone)
    raise ValueError("unit must be seconds, minutes, hours or days")


def batch_time(ms: str, n: int, unit: str, zone: str = "UTC") -> Column:
    return F.expr(batch_time_sql(ms, n, unit, zone))


def previous_batch_time(ms: str, n: int, unit: str, zone: str = "UTC") -> Column:
    """Bucket of ``ms - n units``."""
    u = unit.lower().rstrip("s")
    shift = n * UNIT_MS[u]
    return F.expr(batch_time_sql(f"({ms} - {shift})", n, unit, zone))


# --- local shifts and differences (B11, B12) ----------------------------------

def shift_ms(ms: str, n: int, unit: str, zone: str = "UTC") -> Column:
    """``ms`` moved by ``n`` units of local (wall-clock) time."""
    unit = unit.upper().rstrip("S")
    return F.expr(local_to_ms_sql(add_local_sql(unit, n, local_ts_sql(ms, zone)), zone))


def days_between(ms1: str, ms2: str, zone: str = "UTC") -> Column:
    """Whole local days from ``ms1`` to ``ms2``."""
    return F.expr(f"datediff(cast({local_ts_sql(ms2, zone)} as date), "
                  f"cast({local_ts_sql(ms1, zone)} as date))")


# Pattern letters that ``format_ms`` knows, with the field each one stands for.
_FIELDS = {"yyyy": ("year", 4), "MM": ("month", 2), "dd": ("day", 2), "HH": ("hour", 2),
           "mm": ("minute", 2), "ss": ("second", 2)}


def format_ms(ms: str, pattern: str, zone: str = "UTC") -> Column:
    """Wall-clock text of epoch ms in ``zone``. Patterns of yyyy, MM, dd, HH, mm, ss
    and ``SSS`` are put together from the fields; other letters raise."""
    local, out = local_ts_sql(ms, zone), []
    for part in re.finditer(r"([A-Za-z])\1*|[^A-Za-z]+", pattern):
        t = part.group(0)
        if t in _FIELDS:
            fn, width = _FIELDS[t]
            out.append(f"lpad(cast({fn}({local}) as string), {width}, '0')")
        elif t == "SSS":
            out.append(f"lpad(cast(pmod({ms}, 1000) as string), 3, '0')")
        elif t[0].isalpha():
            raise ValueError(f"pattern letters {t!r} are not supported")
        else:
            out.append("'" + t.replace("'", "") + "'")
    return F.expr(f"concat({', '.join(out)})")
