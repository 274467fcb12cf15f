"""Error measures as aggregate expressions; null actuals are left out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rmse(actual: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg(F.pow(actual - predicted, 2)))


def mape(actual: Column, predicted: Column) -> Column:
    """Mean absolute error relative to the actual (a fraction); zero actuals are left out."""
    return F.avg(F.abs(actual - predicted) / F.nullif(actual, F.lit(0.0)))
