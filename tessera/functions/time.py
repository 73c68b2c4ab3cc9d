"""Date/time expressions with the source database's semantics.

* ``diff_units`` = TIMESTAMPDIFF(unit, a, b): whole units, truncated toward zero.
* month arithmetic clamps to month end (DATE_ADD ... INTERVAL n MONTH).
* Reference time is always an explicit ``timestamp_ntz`` literal, never NOW().
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(value: datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal (no session-time-zone shift)."""
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.expr(f"TIMESTAMP_NTZ '{value}'")


def date_lit(value: date | datetime | str) -> Column:
    if isinstance(value, (date, datetime)):
        value = value.strftime("%Y-%m-%d")
    return F.expr(f"DATE '{value[:10]}'")


_UNIT_MICROS = {"MICROSECOND": 1, "SECOND": 10**6, "MINUTE": 60 * 10**6, "HOUR": 3600 * 10**6,
                "DAY": 86400 * 10**6, "WEEK": 7 * 86400 * 10**6}
_UNIT_MONTHS = {"MONTH": 1, "QUARTER": 3, "YEAR": 12}


def _micros_of_minute(ts: Column) -> Column:
    return (F.date_part(F.lit("SECOND"), ts) * 1000000).cast("bigint")     # decimal(8,6): compact, exact


def _wall_micros(c: Column) -> Column:
    """Wall-clock microseconds since 1970-01-01 of a DATE / TIMESTAMP_NTZ
    value from zone-free parts, in 64-bit integers (``timestampdiff`` on
    TIMESTAMP_NTZ goes through the session time zone and is off by an hour
    when a value falls in a DST gap)."""
    ts = c.cast("timestamp_ntz")
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    minutes = days * 1440 + F.hour(ts) * 60 + F.minute(ts)
    return minutes * 60000000 + _micros_of_minute(ts)


def _day_time_micros(c: Column) -> Column:
    ts = c.cast("timestamp_ntz")
    minutes = F.dayofmonth(ts).cast("bigint") * 1440 + F.hour(ts) * 60 + F.minute(ts)
    return minutes * 60000000 + _micros_of_minute(ts)


def _trunc_div(a: Column, b: int) -> Column:
    """Exact 64-bit integral division truncating toward zero (SQL ``div``)."""
    return F.call_function("div", a, F.lit(b).cast("bigint"))


def diff_units(unit: str, start: Column, end: Column) -> Column:
    """TIMESTAMPDIFF(unit, start, end): whole units, truncated toward zero;
    months compare (day, time of day) like the source database.  Zone-free
    for DATE and TIMESTAMP_NTZ inputs; 64-bit integer arithmetic."""
    unit = unit.upper()
    if unit in _UNIT_MONTHS:
        s, e = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
        m = (F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))
        rs, re_ = _day_time_micros(s), _day_time_micros(e)
        months = F.when((m > 0) & (re_ < rs), m - 1).when((m < 0) & (re_ > rs), m + 1).otherwise(m).cast("bigint")
        return months if _UNIT_MONTHS[unit] == 1 else _trunc_div(months, _UNIT_MONTHS[unit])
    if unit in ("SECOND", "MINUTE", "HOUR", "DAY"):
        # NTZ - NTZ is a day-time interval computed without the session zone;
        # casting it to a single-unit interval truncates toward zero
        delta = end.cast("timestamp_ntz") - start.cast("timestamp_ntz")
        return delta.cast(f"interval {unit.lower()}").cast("bigint")
    return _trunc_div(_wall_micros(end) - _wall_micros(start), _UNIT_MICROS[unit])


def add_days(ts: Column, days) -> Column:
    return F.timestamp_add("DAY", days if isinstance(days, Column) else F.lit(days), ts)


def add_minutes(ts: Column, minutes) -> Column:
    return F.timestamp_add("MINUTE", minutes if isinstance(minutes, Column) else F.lit(minutes), ts)


def add_months_ts(d: Column, months) -> Column:
    """DATE_ADD(date, INTERVAL n MONTH) on a DATE, clamped to month end."""
    return F.add_months(d, months if isinstance(months, Column) else F.lit(months))


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def weekday_sun1(ts: Column) -> Column:
    """DAYOFWEEK: Sunday = 1 .. Saturday = 7."""
    return F.dayofweek(ts)


_EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def ntz_to_instant(ts: Column) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP read as UTC, independent of the session
    time zone (streaming watermarks require TIMESTAMP)."""
    return F.timestamp_micros(_wall_micros(ts))


def instant_to_ntz(ts: Column) -> Column:
    """Inverse of ``ntz_to_instant``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr(_EPOCH_NTZ))
