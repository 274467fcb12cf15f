"""Calendar columns, holidays, off-work probability and bridge days.

These run on the daily table (one row per key and date) and reach the hours by
the join of the day, not on 24 copies of each day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.functions.clock import day_number
from gridcast.functions.dates import date_parts, holidays_of_year, is_holiday, one_hot
from gridcast.operators.lags import HaloWindow

# Daily tables are cut into four-year windows with one day of overlap.
FOUR_YEARS = 1461


def add_calendar(df: DataFrame, date: str = "date") -> DataFrame:
    return df.withColumns(date_parts(F.col(date)))


def add_dummies(df: DataFrame) -> DataFrame:
    """``month_1..12`` and ``weekday_0..6``, whatever values are present."""
    return df.withColumns({**one_hot("month", range(1, 13)), **one_hot("weekday", range(7))})


def holiday_dimension(years: DataFrame) -> DataFrame:
    """One row per holiday date of the distinct years in ``years(year)``: at most 11 per year."""
    days = years.select("year").distinct().select(F.explode(holidays_of_year(F.col("year"))).alias("date"))
    return days.distinct()


def flag_holidays(
    df: DataFrame, years: DataFrame | None = None, date: str = "date", out: str = "holiday"
) -> DataFrame:
    """0/1 holiday flag.

    With ``years(year)``, by join with the holiday dimension of these years (broadcast: at most 11 rows per calendar
    year); they must be those of ``df`` (``years_of``).  Without, by the calendar rule of the row's own year, which
    needs no join and no pass over the data to find the years.
    """
    if years is None:
        return df.withColumn(out, is_holiday(F.col(date)).cast("int"))
    dim = F.broadcast(holiday_dimension(years).select(F.col("date").alias(date), F.lit(1).alias(out)))
    return df.join(dim, date, "left").withColumn(out, F.coalesce(out, F.lit(0)))


def years_of(df: DataFrame, date: str = "date") -> DataFrame:
    """The distinct years of a table, one row each."""
    return df.select(F.year(date).alias("year")).where("year IS NOT NULL").distinct()


def off_work_probability(
    weekday: Column, christmas: Column, august: Column, bank_holiday: Column, school: Column
) -> Column:
    """Probability (0-100) of being off work.

    Strongest rule first: school holidays, bank holidays, August, Christmas,
    Saturday, Sunday.  A rule applies when its value is positive.
    """
    return (
        F.when(school > 0, school)
        .when(bank_holiday > 0, 100.0)
        .when(august > 0, august)
        .when(christmas > 0, christmas)
        .when(weekday == 5, 80.0)
        .when(weekday == 6, 100.0)
        .otherwise(0.0)
    )


def add_bridge_days(
    daily: DataFrame,
    off: Column,
    keys: Sequence[str] = (),
    mode: str = "as_coded",
    probability: str | None = None,
    date: str = "date",
) -> DataFrame:
    """``bridge`` flag from the off-work flags (0/1) of a day and its two neighbours.

    ``as_coded``: exactly one of the three days is off.  ``sandwich``: a working
    day between two days off.  Rows at the ends of a series get 0.  With
    ``probability``, that column becomes 50 on bridge days.  The table must have
    one row per key and calendar day without gaps.
    """
    halo = HaloWindow(keys, day_number(F.col(date)), FOUR_YEARS, before=1, after=1)
    out = halo.select(
        daily.withColumn("_off", off.cast("int")),
        {"_prev": lambda w: F.lag("_off").over(w), "_next": lambda w: F.lead("_off").over(w)},
    )
    me, prev, following = F.col("_off"), F.col("_prev"), F.col("_next")
    if mode == "as_coded":
        hit = (prev + following + me) == 1
    elif mode == "sandwich":
        hit = (me == 0) & (prev == 1) & (following == 1)
    else:
        raise ValueError(f"mode must be 'as_coded' or 'sandwich', not {mode!r}")
    out = out.withColumn("bridge", F.coalesce(hit, F.lit(False)).cast("int"))
    if probability:
        out = out.withColumn(probability, F.when(F.col("bridge") == 1, 50.0).otherwise(F.col(probability)))
    return out.drop("_off", "_prev", "_next")
