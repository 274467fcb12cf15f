"""Long-term trend and climatology."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.operators.regression import fit_grouped_linear, score
from gridcast.operators.splits import day

_X = ("_u", "_u2")


def add_trend(
    df: DataFrame, keys: Sequence[str], y: str, before: str, base_year: int, out: str = "trend"
) -> DataFrame:
    """Quadratic trend over the years, fitted on rows dated before ``before``.

    The fit uses ``year - base_year``: the raw year and its square are nearly
    collinear.  Adds ``year_squared`` and the trend value to every row.
    """
    u = F.year("date") - base_year
    wide = df.withColumns({"_u": u.cast("double"), "_u2": (u * u).cast("double")})
    model = fit_grouped_linear(wide.filter(F.col("date") < day(before)), keys, _X, y)
    wide = score(wide, model, keys, _X, out=out)
    return wide.withColumn("year_squared", F.year("date") * F.year("date")).drop(*_X)


def climatology(
    df: DataFrame, keys: Sequence[str], y: str, cut: str, years: int, root_extremes: bool = True
) -> DataFrame:
    """Mean, min and max of ``y`` per day of year over the ``years`` before ``cut``.

    ``root_extremes`` gives the square roots of min and max.
    """
    date = F.col("date")
    recent = df.filter((date >= F.add_months(day(cut), -12 * years)) & (date < day(cut)))
    shape = (lambda c: F.sqrt(c)) if root_extremes else (lambda c: c)
    return recent.groupBy(*keys, F.dayofyear("date").alias("day_of_year")).agg(
        F.avg(y).alias("clim_mean"), shape(F.min(y)).alias("clim_min"), shape(F.max(y)).alias("clim_max")
    )


def add_climatology(
    df: DataFrame, keys: Sequence[str], y: str, cut: str, years: int, root_extremes: bool = True
) -> DataFrame:
    """Climatology as columns of every row, by day of year."""
    table = climatology(df, keys, y, cut, years, root_extremes)
    return df.withColumn("day_of_year", F.dayofyear("date")).join(table, [*keys, "day_of_year"], "left")
