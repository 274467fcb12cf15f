"""Forecast errors per hour, horizon, day and month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.functions.metrics import mape, rmse


def _errors(actual: str, predicted: str) -> list[Column]:
    a, p = F.col(actual), F.col(predicted)
    return [F.count(a - p).alias("n"), rmse(a, p).alias("rmse"), mape(a, p).alias("mape")]


def kpis(df: DataFrame, by: Sequence[str] = (), actual: str = "load", predicted: str = "prediction") -> DataFrame:
    """RMSE and MAPE (a fraction) per group, or overall without ``by``; null actuals are left out."""
    return df.groupBy(*by).agg(*_errors(actual, predicted))


def kpi_rollup(df: DataFrame, by: Sequence[str], actual: str = "load", predicted: str = "prediction") -> DataFrame:
    """RMSE and MAPE at every level of ``by`` and overall, in one pass."""
    return df.rollup(*by).agg(F.grouping_id().alias("level"), *_errors(actual, predicted))


def monthly_kpis(
    df: DataFrame, keys: Sequence[str] = (), actual: str = "load", predicted: str = "prediction"
) -> DataFrame:
    """Unweighted mean over a month's days of the daily RMSE and MAPE."""
    daily = kpis(df, [*keys, "date"], actual, predicted)
    return daily.groupBy(*keys, F.trunc("date", "MM").alias("month")).agg(
        F.count("rmse").alias("days"), F.avg("rmse").alias("rmse"), F.avg("mape").alias("mape")
    )


def modal_value(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent value per group; the smallest one on ties."""
    counts = df.groupBy(*by, column).agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col(column)))
    out = counts.groupBy(*by).agg(best.alias("_best"))
    return out.select(*by, F.col(f"_best.{column}").alias(column), (-F.col("_best.m")).alias("n"))


def importance_share(df: DataFrame, weight: str, by: Sequence[str] = (), out: str = "share") -> DataFrame:
    """Weights as a share of their group's total."""
    totals = df.groupBy(*by).agg(F.sum(weight).alias("_total"))
    if by:
        wide = df.join(totals, list(by))
    else:
        wide = df.withColumn("_total", totals.scalar())
    return wide.withColumn(out, F.col(weight) / F.nullif(F.col("_total"), F.lit(0.0))).drop("_total")
