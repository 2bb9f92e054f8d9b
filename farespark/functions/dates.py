"""Date parts with the reference's conventions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday numbering 0 = Sunday .. 6 = Saturday and its names.
WEEKDAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_date_part(ts: str | Column) -> Column:
    return F.to_date(_c(ts))


def days_before(departure_at: str | Column, captured_at: str | Column) -> Column:
    """Whole calendar days between the two dates (int, may be negative)."""
    return F.datediff(F.to_date(_c(departure_at)), F.to_date(_c(captured_at)))


def dow_sunday0(ts: str | Column) -> Column:
    """0 = Sunday .. 6 = Saturday (Spark's dayofweek is 1 = Sunday)."""
    return (F.dayofweek(_c(ts)) - 1).cast("int")


def hour_of(ts: str | Column) -> Column:
    return F.hour(_c(ts)).cast("int")


def weekday_name(dow: str | Column) -> Column:
    """0..6 -> name; anything else (and NULL) -> NULL. Not locale-bound."""
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    d = _c(dow)
    return F.when((d >= 0) & (d <= 6), F.get(names, d.cast("int")))


def add_days(ts: str | Column, n: str | Column | int) -> Column:
    n_col = F.lit(n) if isinstance(n, int) else _c(n)
    return _c(ts) + F.make_dt_interval(days=n_col)


def iso_date(d: str | Column) -> Column:
    """Date as ISO text 'yyyy-MM-dd' (H18)."""
    return F.date_format(_c(d), "yyyy-MM-dd")


def wall_lit(v) -> Column:
    """Literal of a wall-clock value that no time zone can shift.

    ``F.lit(naive datetime)`` makes a session-zone TIMESTAMP through the
    Python process's local zone; a driver outside UTC would move every
    watermark. Datetimes become TIMESTAMP_NTZ parsed from ISO text (aware
    ones are converted to UTC first); dates stay DATE.
    """
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(v, dt.date):
        return F.lit(v.isoformat()).cast("date")
    return F.lit(v)
