"""Fit, forecast and judge: next day, several days, long term, walk-forward."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.operators.readings import drop_incomplete
from gridcast.operators.regression import fit_folds, fit_grouped_linear, score
from gridcast.operators.splits import split_day, split_horizon, split_long_term, split_window
from gridcast.operators.boosted import fit_hourly_gbt
from gridcast.operators.climate import NEUTRAL_TEMPERATURE, climate_part, counterfactual, neutral_weather
from gridcast.operators.trees import read_nodes, score_trees
from gridcast.operators.trend import add_trend
from gridcast.session import stage
from gridcast.sources.store import save_models


def _target(y: str, shift: float) -> Column:
    return F.when(F.col(y) + shift > 0, F.ln(F.col(y) + shift))


def fit_load(
    train: DataFrame, by: Sequence[str], x: Sequence[str], y: str = "load", shift: float = 0.0
) -> DataFrame:
    """One model per group on ``ln(load + shift)``; ``shift=1`` admits hours without load."""
    return fit_grouped_linear(train.withColumn("_target", _target(y, shift)), by, x, "_target")


def predict_load(
    rows: DataFrame, model: DataFrame, by: Sequence[str], x: Sequence[str], shift: float = 0.0
) -> DataFrame:
    """Scores stored models; rows may lack actuals."""
    scored = score(rows, model, by, x, log=True)
    return scored.withColumn("prediction", F.col("prediction") - shift) if shift else scored


def forecast_day(
    features: DataFrame, keys: Sequence[str], cut, x: Sequence[str], shift: float = 0.0
) -> DataFrame:
    """Next-day forecast: models per series and hour from the days before ``cut``."""
    by = [*keys, "hour"]
    train, test = split_day(features, cut)
    scored = predict_load(test, fit_load(train, by, x, shift=shift), by, x, shift)
    return scored.select(*keys, "date", "hour", "load", "prediction")


def forecast_days(
    features: DataFrame, keys: Sequence[str], cut, x: Sequence[str], shift: float = 0.0,
    models: Sequence[str] | None = None,
) -> DataFrame:
    """Multi-day forecast: models per series, horizon and hour, all in one job.

    ``models`` names the keys that have models of their own (all); ``()`` pools the series.
    """
    by = [*(keys if models is None else models), "horizon", "hour"]
    train, test = split_horizon(features, cut)
    scored = predict_load(test, fit_load(train, by, x, shift=shift), by, x, shift)
    return scored.select(*keys, "horizon", "date", "hour", "load", "prediction")


def forecast_long_term(
    df: DataFrame, keys: Sequence[str], cut: str, x: Sequence[str], by: Sequence[str] = (),
    years: int = 3, y: str = "load", target: str = "log",
) -> DataFrame:
    """Forecast of the ``years`` from ``cut``: quadratic trend plus calendar and weather regressors.

    The trend is fitted on rows before ``cut - years``, the models on the
    ``years`` before ``cut`` with the trend as a regressor.  ``target='residual'``
    fits the difference to the trend and adds the trend back.
    """
    first = F.add_months(F.lit(cut).cast("date"), -12 * years)
    wide = add_trend(df, keys, y, first, base_year=int(cut[:4]) - years)
    groups = [*keys, *by]
    train, test = split_long_term(wide, cut, years)
    if target == "log":
        scored = predict_load(test, fit_load(train, groups, [*x, "trend"], y), groups, [*x, "trend"])
    elif target == "residual":
        model = fit_grouped_linear(train.withColumn("_rest", F.col(y) - F.col("trend")), groups, x, "_rest")
        scored = score(test, model, groups, x)
        scored = scored.withColumn("prediction", F.col("prediction") + F.col("trend"))
    else:
        raise ValueError(f"target must be 'log' or 'residual', not {target!r}")
    return scored.select(*keys, "date", *[c for c in by if c != "date"], y, "trend", "prediction")


def backtest(
    df: DataFrame, keys: Sequence[str], x: Sequence[str], by: Sequence[str] = (), y: str = "load",
    shift: float = 0.0, unit: str = "month", issued: str = "date", models: Sequence[str] | None = None,
) -> DataFrame:
    """Walk-forward test: models renewed at the start of each ``unit`` (month, week) from all
    earlier rows, every row scored with the latest model at the time it was issued.

    Every row with known regressors is in the result, also one whose load is not known yet; its prediction is null
    only where nothing was known before its period.  With several horizons pass ``issued="issue_date"``: a model then
    never knows targets of the period in which the forecast was made.  ``models`` as in ``forecast_days``.
    """
    groups = [*(keys if models is None else models), *by]
    # the same rows for fit and score, so that both read one preparation
    rows = drop_incomplete(df.withColumn("fold", F.trunc(issued, unit)), [*keys, *by, "date", "fold", *x])
    folds = None if issued == "date" else rows.select(*groups, "fold").distinct()
    model = fit_folds(rows.withColumn("_target", _target(y, shift)), groups, x, "_target", unit=unit, folds=folds)
    return predict_load(rows, model, [*groups, "fold"], x, shift)


def split_off_weather(
    features: DataFrame, keys: Sequence[str], start, end, x: Sequence[str], shift: float = 0.0,
    train_until=None, value: float = NEUTRAL_TEMPERATURE,
) -> DataFrame:
    """Weather part of the load on ``[start, end)``: actual minus the load under neutral weather."""
    by = [*keys, "hour"]
    train, test = split_window(features, start, end, train_until)
    model = fit_load(train, by, x, shift=shift)
    neutral = counterfactual(test, model, by, x, log=True, value=value)
    neutral = neutral.withColumn("neutral_load", F.col("neutral_load") - shift)
    part = climate_part(F.col("load"), F.col("neutral_load"))
    return neutral.withColumn("climate_part", part).select(
        *keys, "date", "hour", "load", "neutral_load", "climate_part"
    )


def split_off_weather_boosted(
    features: DataFrame, keys: Sequence[str], start, end, x: Sequence[str], store: str, train_until=None,
    value: float = NEUTRAL_TEMPERATURE, **how,
) -> DataFrame:
    """``split_off_weather`` by one boosted model per hour, pooled over all series, with the climate settings.

    The models are kept in the folder ``store``; ``how`` goes to ``fit_hourly_gbt``.  All rows get their load under neutral
    weather in one scan.  Where a load is not known there is no part; hours without load teach nothing.
    """
    table = stage(features)
    train, test = split_window(table, start, end, train_until)
    save_models(fit_hourly_gbt(train, x, "load", **{"kind": "climate", **how}), store, by=("hour",))
    nodes = read_nodes(features.sparkSession, store, {"hour": "int"})
    neutral = score_trees(neutral_weather(test, value), nodes, x, ["hour"], out="neutral_load")
    part = climate_part(F.col("load"), F.col("neutral_load"))
    return neutral.withColumn("climate_part", part).select(
        *keys, "date", "hour", "load", "neutral_load", "climate_part"
    )


def attach_actuals(forecast: DataFrame, actuals: DataFrame, on: Sequence[str]) -> DataFrame:
    """Forecast with the actuals known so far; hours without one keep a null."""
    return forecast.join(actuals, list(on), "left")

