"""Time helpers that behave the same for TIMESTAMP, TIMESTAMP_NTZ and DATE
and never depend on the session time zone."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNIT_MICROS = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
    "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def duration_micros(value) -> int:
    """'30 minutes', '1 day', a timedelta or an int (micros) -> micros."""
    if isinstance(value, _dt.timedelta):
        return int(value.total_seconds() * 1_000_000)
    if isinstance(value, int):
        return value
    m = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([a-zA-Z]+?)s?\s*", str(value))
    if not m or m.group(2).lower() not in _UNIT_MICROS:
        raise ValueError(f"cannot parse duration {value!r}")
    return int(float(m.group(1)) * _UNIT_MICROS[m.group(2).lower()])


def duration_sql(value) -> str:
    """Duration as a Spark interval literal body, e.g. '1800 seconds'."""
    micros = duration_micros(value)
    if micros % 1_000_000 == 0:
        return f"{micros // 1_000_000} seconds"
    return f"{micros} microseconds"


def col_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Micro-seconds since 1970-01-01 (wall clock for NTZ, UTC for LTZ)."""
    dt = col_type(df, name)
    c = F.col(name)
    if isinstance(dt, T.TimestampNTZType):
        # calendar day and time of day of an NTZ value never involve a zone
        # (timestampdiff would cast to the session zone and bend at DST)
        day = F.unix_date(c.cast("date")).cast("long") * F.lit(86_400_000_000)
        tod = ((F.hour(c) * 3600 + F.minute(c) * 60).cast("long") * F.lit(1_000_000)
               + (F.expr(f"extract(SECOND FROM `{name}`)") * 1_000_000).cast("long"))
        return day + tod
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("long") * F.lit(86_400_000_000)
    return c.cast("long")


def to_day(c: Column | str) -> Column:
    """Calendar day of a timestamp/date column (casting NTZ->DATE is TZ free)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("date")


def month_start(c: Column | str, like_ntz: bool = True) -> Column:
    """First instant of the month, as TIMESTAMP_NTZ (TZ free)."""
    m = F.trunc(to_day(c), "month")
    return m.cast("timestamp_ntz") if like_ntz else m


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole days from ``earlier`` to ``later`` on calendar days (INT)."""
    return F.datediff(to_day(later), to_day(earlier))


def ntz_from_micros(micros: Column) -> Column:
    """Inverse of ``epoch_micros`` for NTZ: wall-clock TIMESTAMP_NTZ built
    from calendar components, independent of the session time zone."""
    day_us = F.lit(86_400_000_000)
    days = F.floor(micros / day_us).cast("int")
    tod = micros - days.cast("long") * day_us
    date = F.date_add(F.lit("1970-01-01").cast("date"), days)
    secs = (tod % 60_000_000).cast("decimal(18,0)") / F.lit(1_000_000)
    return F.make_timestamp_ntz(F.year(date), F.month(date), F.dayofmonth(date),
                                (tod / 3_600_000_000).cast("int"), ((tod / 60_000_000) % 60).cast("int"),
                                secs.cast("decimal(16,6)"))

