"""Joining sources to a panel: by day, by key, by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcast.operators.ranges import find_ranges
from gridcast.operators.readings import dedup_first


def one_per_date(daily: DataFrame) -> DataFrame:
    """One row per date: of repeated dates the first by ``_line`` (the order of the feed), which is dropped; a table
    without ``_line`` has no order, and its smallest row stays."""
    order = ["_line"] if "_line" in daily.columns else [c for c in daily.columns if c != "date"]
    return dedup_first(daily, ["date"], order).drop("_line")


def join_daily(df: DataFrame, daily: DataFrame, on: Sequence[str] = ("date",), how: str = "inner") -> DataFrame:
    """Attach one daily row to every row of its date.

    A table keyed by ``date`` alone is first brought to one row per date (``one_per_date``), so it holds at most 366
    rows per calendar year and can be broadcast.  A table keyed by series as well grows with the data: Spark picks the
    join from its size.
    """
    if list(on) == ["date"]:
        return df.join(F.broadcast(one_per_date(daily)), "date", how)
    return df.join(daily, list(on), how)


def fill_dates(daily: DataFrame) -> DataFrame:
    """Every date from the first to the last of a table with one row per date; the other columns of an added date are
    null.  Windows that count rows need such an axis."""
    span = daily.agg(F.min("date").alias("a"), F.max("date").alias("b")).where("a IS NOT NULL")
    axis = span.select(F.explode(F.sequence("a", "b")).alias("date"))
    return axis.join(daily, "date", "left").select(daily.columns)


#: Rows that one task numbers, about; the ranges of an order grow beyond ``ranges.MOST_RANGES`` times as many.
NUMBERED_ROWS = 1 << 18


def row_positions(
    df: DataFrame, keys: Sequence[str], date: str, order: Sequence[str], out: str = "position", rows: int = NUMBERED_ROWS
) -> DataFrame:
    """0-based position of each row in its series, by ``order``.

    The order (keys, ``date``, ``order``) of all rows is cut into ranges of about ``rows`` rows, whatever series or
    date they belong to.  Rows are numbered within their range and shifted by the row counts of the series' ranges
    before (a small table), so a series or month with a third of all rows is spread over tasks.  Only rows that are
    equal in all columns of the order meet in one range; their order is open.  A table of one range (the rows are
    counted first) needs no cuts, and its series are numbered as they are.
    """
    keys = list(keys)
    by = list(dict.fromkeys([date, *order]))
    total = df.count()
    if total <= rows:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
        return df.withColumn(out, (place - 1).cast("long"))
    ranges = find_ranges(df, [*keys, *by], rows, total)
    numbered = ranges.number(df.withColumn("_key", F.struct(*keys, *by)), "_key", "_range").drop("_key")
    counts = numbered.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_range").alias("_at"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    same = F.col("_range") == F.col("_at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    place = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*by))
    shifted = numbered.withColumn(out, (place - 1).cast("long")).join(starts, same)
    return shifted.withColumn(out, F.col("_start") + F.col(out)).select(*df.columns, out)


def zip_by_position(
    left: DataFrame, right: DataFrame, keys: Sequence[str], date: str = "date",
    order: Sequence[str] = ("date",), columns: Sequence[str] = (),
) -> DataFrame:
    """Attach ``columns`` of the right table row by row, in time order; null where it is shorter."""
    keys = list(keys)
    a = row_positions(left, keys, date, order)
    b = row_positions(right, keys, date, order).select(*keys, "position", *columns)
    return a.join(b, [*keys, "position"], "left")
