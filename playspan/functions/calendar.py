"""Dates, hours and gaps of play timestamps (UTC session time zone)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from playspan import fixed


def as_utc(ts: Column) -> Column:
    """Zone-less parquet timestamps become ordinary ones."""
    return ts.cast("timestamp")


def weekday_number(ts: Column) -> Column:
    """Sunday = 0 .. Saturday = 6."""
    return (F.dayofweek(ts) - 1).cast("long")


def weekday_name(ts: Column) -> Column:
    """Full English name of the day."""
    return F.date_format(ts, "EEEE")


def local_time(ts: Column, hours: int = fixed.LOCAL_OFFSET_HOURS) -> Column:
    """Fixed offset behind UTC, without daylight saving."""
    return ts - F.expr(f"INTERVAL {int(hours)} HOURS")


def calendar_parts(ts: Column) -> dict[str, Column]:
    """The calendar columns of a play."""
    return {
        "played_date": F.to_date(ts),
        "played_year": F.year(ts).cast("long"),
        "played_month": F.month(ts).cast("long"),
        "played_day": F.dayofmonth(ts).cast("long"),
        "played_hour": F.hour(ts).cast("long"),
        "played_day_of_week": weekday_number(ts),
        "played_day_name": weekday_name(ts),
    }


def minutes_between(earlier: Column, later: Column) -> Column:
    """Gap in minutes with microsecond precision."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return micros.cast("double") / F.lit(1e6) / F.lit(60.0)


def leading_year(text: Column, strict: bool = True) -> Column:
    """Year of a date given as ``YYYY``, ``YYYY-MM`` or ``YYYY-MM-DD``.

    ``strict`` raises on other text; otherwise it becomes NULL.
    """
    head = F.substring(text, 1, 4)
    return head.cast("int") if strict else head.try_cast("int")
