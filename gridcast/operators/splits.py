"""Train and test sets by date.  Bounds are literals, so they reach the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day(text: str | Column) -> Column:
    return F.lit(text).cast("date") if isinstance(text, str) else text


def split_day(df: DataFrame, cut) -> tuple[DataFrame, DataFrame]:
    """Train before ``cut``, test on that day."""
    return df.filter(F.col("date") < day(cut)), df.filter(F.col("date") == day(cut))


def split_horizon(df: DataFrame, cut) -> tuple[DataFrame, DataFrame]:
    """Train on targets before ``cut``, test each ``horizon`` on its day ``cut + horizon - 1``."""
    target = F.date_add(day(cut), F.col("horizon") - 1)
    return df.filter(F.col("date") < day(cut)), df.filter(F.col("date") == target)


def split_long_term(df: DataFrame, cut, years: int = 3) -> tuple[DataFrame, DataFrame]:
    """Train on the ``years`` before ``cut``, test on the ``years`` from ``cut``."""
    first, last = F.add_months(day(cut), -12 * years), F.add_months(day(cut), 12 * years)
    date = F.col("date")
    return df.filter((date >= first) & (date < day(cut))), df.filter((date >= day(cut)) & (date < last))


def split_window(df: DataFrame, start, end, train_until=None) -> tuple[DataFrame, DataFrame]:
    """Test on ``[start, end)``, train before ``train_until``.

    By default training runs up to ``end`` and includes the test window: right for
    splitting a known period into parts, wrong for judging a forecast.
    """
    date = F.col("date")
    until = day(end if train_until is None else train_until)
    return df.filter(date < until), df.filter((date >= day(start)) & (date < day(end)))


def until_axis_end(df: DataFrame, cut, years: int = 3) -> DataFrame:
    """Rows from ``cut`` up to 00:00 of the day ``years`` later, included."""
    end = F.add_months(day(cut), 12 * years)
    date, hour = F.col("date"), F.col("hour")
    return df.filter((date >= day(cut)) & ((date < end) | ((date == end) & (hour == 0))))
