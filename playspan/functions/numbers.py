"""Rounding and unit conversion in double precision."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_to(value: Column, digits: int) -> Column:
    """Round half away from zero on the scaled double.

    Scaling first and rounding to a whole number decides near-ties the way
    engines with C ``round`` do; ``F.round(x, n)`` would decide them on the
    shortest decimal text of x.
    """
    scale = F.lit(float(10**digits))
    return F.round(value.cast("double") * scale, 0) / scale


def minutes_of(millis: Column) -> Column:
    return millis.cast("double") / F.lit(60000.0)


def hours_of(millis: Column) -> Column:
    return millis.cast("double") / F.lit(3600000.0)


def ratio(part: Column, whole: Column) -> Column:
    """Division in doubles; NULL when the divisor is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
