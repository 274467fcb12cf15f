"""Hours, clock texts and integer time axes.

All arithmetic stays on DATE, INT and DOUBLE, so nothing depends on the session
time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _minutes(text: Column) -> Column:
    """Minutes of ``HH:mm``; null for any other text."""
    part = F.split(text, ":")
    return F.get(part, F.lit(0)).try_cast("int") * 60 + F.get(part, F.lit(1)).try_cast("int")


def parse_hour(text: Column) -> Column:
    """``HH:mm`` to a decimal hour in [0, 24): ``10:30`` -> 10.5, ``24:00`` -> 0.0."""
    return (_minutes(text) % 1440) / F.lit(60.0)


def parse_day(date: Column, text: Column, hour24: str = "same_day") -> Column:
    """Date of a ``(date, HH:mm)`` pair.

    ``24:00`` stays on its own date with ``same_day`` (the default) and moves to
    the following date with ``next_day``.
    """
    if hour24 == "same_day":
        return date
    if hour24 == "next_day":
        return F.date_add(date, F.floor(_minutes(text) / 1440).cast("int"))
    raise ValueError(f"hour24 must be 'same_day' or 'next_day', not {hour24!r}")


def parse_clock(text: Column, decimal: bool = False) -> Column:
    """Clock text to a number: ``07:45`` -> 7.45, or 7.75 with ``decimal``."""
    if decimal:
        return _minutes(text) / F.lit(60.0)
    return F.replace(text, F.lit(":"), F.lit(".")).try_cast("double")


def feed_stamp(date: Column, hour: Column) -> Column:
    """``dd/MM/yyyy  HH:mm`` for a date and a decimal hour."""
    minutes = F.round(hour * 60).cast("int")
    hh = F.lpad(F.floor(minutes / 60).cast("string"), 2, "0")
    mm = F.lpad((minutes % 60).cast("string"), 2, "0")
    return F.concat(F.date_format(date, "dd/MM/yyyy"), F.lit("  "), hh, F.lit(":"), mm)


def hour_number(date: Column, hour: Column) -> Column:
    """Hours since 1970-01-01: the step axis of a panel."""
    return F.unix_date(date).cast("bigint") * 24 + hour


def day_number(date: Column) -> Column:
    """Days since 1970-01-01: the step axis of a daily table."""
    return F.unix_date(date).cast("bigint")


def number_to_date(number: Column) -> Column:
    """Date of an ``hour_number``."""
    return F.date_from_unix_date(F.floor(number / 24).cast("int"))


def number_to_hour(number: Column) -> Column:
    """Hour of day of an ``hour_number``."""
    return F.pmod(number, F.lit(24)).cast("int")
