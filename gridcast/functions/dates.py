"""Calendar expressions: date parts, Easter, holidays, one-hot columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names, Monday first.
WEEKDAY_NAMES = ("Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche")

# Holidays on the same (month, day) every year.
FIXED_HOLIDAYS = ((1, 1), (1, 27), (5, 1), (8, 15), (11, 1), (11, 19), (12, 8), (12, 25))

# Holidays counted in days from Easter Sunday
# (Easter Sunday, Ascension, Whit Monday).
EASTER_HOLIDAYS = (0, 39, 50)


def date_parts(date: Column) -> dict[str, Column]:
    """Year, month, day of month, day of year and weekday (Monday = 0)."""
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day_of_month": F.dayofmonth(date),
        "day_of_year": F.dayofyear(date),
        "weekday": F.weekday(date),
    }


def weekday_name(date: Column) -> Column:
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    return F.element_at(names, F.weekday(date) + 1)


def _div(a: Column, n: int) -> Column:
    return F.floor(a / n).cast("int")


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter, counted as a number of days from 28 March.

    ``moon`` is the age of the paschal full moon and ``shift`` moves on to the
    following Sunday (the almanac form of the computation).
    """
    golden = year % 19
    century = _div(year, 100)
    epact = (century - _div(century, 4) - _div(8 * century + 13, 25) + 19 * golden + 15) % 30
    late = (epact == 29) | ((epact == 28) & (golden >= 11))
    moon = F.when(late, epact - 1).otherwise(epact)
    shift = (year + _div(year, 4) + moon + 2 - century + _div(century, 4)) % 7
    return F.date_add(F.make_date(year, F.lit(3), F.lit(28)), moon - shift)


def holidays_of_year(year: Column) -> Column:
    """All holidays of a year as an array of dates."""
    fixed = [F.make_date(year, F.lit(m), F.lit(d)) for m, d in FIXED_HOLIDAYS]
    movable = [F.date_add(easter_sunday(year), n) for n in EASTER_HOLIDAYS]
    return F.array(*fixed, *movable)


def is_holiday(date: Column) -> Column:
    return F.array_contains(holidays_of_year(F.year(date)), date)


def is_leap_year(year: Column) -> Column:
    return F.dayofyear(F.make_date(year, F.lit(12), F.lit(31))) == 366


def one_hot(name: str, domain: Iterable[int]) -> dict[str, Column]:
    """0/1 columns ``<name>_<k>`` of column ``name`` over a fixed domain: no pass over the data."""
    return {f"{name}_{k}": F.expr(f"int({name} = {k})") for k in domain}
