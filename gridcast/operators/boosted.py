"""Boosted trees and regularised regression, one model per hour of day (and horizon).

The estimators are Spark ML's.  Features are staged once as a table partitioned
by the model key; each fit reads its own folder.  Fits of different keys are
submitted together, so small ones share the cluster.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.operators.readings import drop_incomplete
from gridcast.session import stage

# Learning rate by hour of day; hours not listed take the default.
DAY_AHEAD_RATE = {0: 0.016, 1: 0.016, 2: 0.017, 3: 0.017, 4: 0.017, 15: 0.03, 17: 0.025, 18: 0.03, 19: 0.025, 20: 0.028}
DAY_AHEAD_RATE_DEFAULT = 0.02
LONG_TERM_RATE = {0: 0.005, 3: 0.007, 4: 0.007, 5: 0.007, 6: 0.008, 7: 0.008, 8: 0.008}
LONG_TERM_RATE_DEFAULT = 0.006
CLIMATE_RATE = 0.05

# Depth, row share, column share, rounds, seed per kind of forecast.
# The column share is the product of the per-tree and per-level shares.
SETTINGS = {
    "day_ahead": dict(maxDepth=5, subsamplingRate=0.86, columns=0.81, maxIter=1200, seed=1301),
    "multi_day": dict(maxDepth=5, subsamplingRate=0.86, columns=0.81, maxIter=1200, seed=1301),
    "long_term": dict(maxDepth=4, subsamplingRate=0.8, columns=0.64, maxIter=1200, seed=1301),
    "climate": dict(maxDepth=5, subsamplingRate=0.85, columns=0.7225, maxIter=500, seed=1301),
}


def learning_rate(kind: str, hour: int) -> float:
    if kind == "climate":
        return CLIMATE_RATE
    if kind == "long_term":
        return LONG_TERM_RATE.get(hour, LONG_TERM_RATE_DEFAULT)
    return DAY_AHEAD_RATE.get(hour, DAY_AHEAD_RATE_DEFAULT)


def hour_settings(kind: str, hour: int, **changes) -> dict:
    """Estimator settings of one hour; ``changes`` override (fewer rounds, another depth)."""
    settings = {**SETTINGS[kind], "stepSize": learning_rate(kind, hour), "minInstancesPerNode": 1, **changes}
    settings["featureSubsetStrategy"] = str(settings.pop("columns"))
    return settings


def with_log_target(df: DataFrame, features: Sequence[str], y: str) -> DataFrame:
    """``features`` vector and ``label = ln(y)``; rows with nulls or ``y <= 0`` are left out."""
    known = drop_incomplete(df.filter(F.col(y) > 0), features)
    vectors = VectorAssembler(inputCols=list(features), outputCol="features").transform(known)
    return vectors.withColumn("label", F.ln(y))


def _vectors(df: DataFrame, features: Sequence[str]) -> DataFrame:
    known = drop_incomplete(df, features)
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(known)


def _groups(hours: Iterable[int], horizons: Iterable[int] | None) -> list:
    """Model keys: ``hour``, or ``(horizon, hour)``."""
    if horizons is None:
        return list(hours)
    return [(j, h) for j in horizons for h in hours]


def _by(keys: Iterable) -> tuple[str, ...]:
    return ("horizon", "hour") if isinstance(next(iter(keys)), tuple) else ("hour",)


def _hour(key) -> int:
    return key[1] if isinstance(key, tuple) else key


def _rows_of(df: DataFrame, key) -> DataFrame:
    if isinstance(key, tuple):
        return df.filter((F.col("horizon") == key[0]) & (F.col("hour") == key[1]))
    return df.filter(F.col("hour") == key)


def _fit_groups(estimator: Callable[[int], object], train: DataFrame, keys: list, parallel: int) -> dict:
    """A model for each key that has rows; a key without any has no model."""
    by = _by(keys)
    there = {tuple(r) if len(by) > 1 else r[0] for r in train.select(*by).distinct().collect()}  # values of model keys, few
    keys = [key for key in keys if key in there]

    def fit(key):
        return key, estimator(_hour(key)).fit(_rows_of(train, key))

    with ThreadPoolExecutor(parallel) as pool:
        return dict(pool.map(inheritable_thread_target(train.sparkSession)(fit), keys))


def fit_hourly_gbt(
    df: DataFrame, features: Sequence[str], y: str, kind: str = "day_ahead", hours: Iterable[int] = range(24),
    horizons: Iterable[int] | None = None, validation: Column | None = None, parallel: int = 8, **changes,
) -> dict:
    """One boosted model per hour (or per horizon and hour) on ``ln(y)``, pooled over all series.

    ``validation`` marks the rows of the evaluation set: rounds stop when its
    error no longer improves.
    """
    keys = _groups(hours, horizons)
    by = _by(keys)
    columns = [F.col("features"), F.col("label")]
    if validation is not None:
        columns.append(validation.alias("held_out"))
    train = stage(with_log_target(df, features, y).select(*by, *columns), by=by)

    def estimator(hour):
        gbt = GBTRegressor(**hour_settings(kind, hour, **changes))
        return gbt.setValidationIndicatorCol("held_out") if validation is not None else gbt

    return _fit_groups(estimator, train, keys, parallel)


def fit_issued_gbt(
    df: DataFrame, features: Sequence[str], y: str, issues: Sequence[str], kind: str = "day_ahead",
    hours: Iterable[int] = range(24), date: str = "date", parallel: int = 8, **changes,
) -> dict:
    """Boosted models that are renewed: one per issue date and hour, ``{(issue, hour): model}``, each fitted on the rows
    before its issue date.  The features are staged once for all of them."""
    train = stage(with_log_target(df, features, y).select("hour", F.col(date).alias("day"), "features", "label"), by=("hour",))

    def fit(key):
        issue, hour = key
        rows = train.where((F.col("hour") == hour) & (F.col("day") < F.lit(issue).cast("date")))
        return key, GBTRegressor(**hour_settings(kind, hour, **changes)).fit(rows)

    with ThreadPoolExecutor(parallel) as pool:
        return dict(pool.map(inheritable_thread_target(train.sparkSession)(fit), [(i, h) for i in issues for h in hours]))


def fit_until_best(
    df: DataFrame, features: Sequence[str], y: str, held_out: Column, kind: str = "climate",
    hours: Iterable[int] = range(24), patience: int = 100, first: int = 128, parallel: int = 8, **changes,
) -> tuple[dict, DataFrame]:
    """Models whose training ends by the error in load units on held-out rows, and the rounds worth keeping.

    A model is fitted for ``first`` rounds on the other rows, then for twice as many, and so on, until ``patience`` rounds
    after its best one have not been better, or up to ``maxIter``.  The first trees of a longer training are those of the
    shorter one (the seed is the same), so all trainings together cost at most twice the last one.  Returns the models and
    (hour, round, loss, rounds): the best round, its error on the held-out rows, and how many rounds were trained.
    """
    most = changes.pop("maxIter", SETTINGS[kind]["maxIter"])
    columns = ["hour", *features, y]
    table = stage(df.select(*columns, held_out.alias("_held_out")), by=("hour",))
    train, test = (table.where(c).drop("_held_out") for c in ("NOT _held_out", "_held_out"))
    todo, rounds, models, chosen = list(hours), min(first, most), {}, {}
    while todo:
        fitted = fit_hourly_gbt(train, features, y, kind, todo, parallel=parallel, maxIter=rounds, **changes)
        curves = learning_curves(test, fitted, features, y)
        for r in best_rounds(curves, patience=patience).collect():  # one row per model
            models[r.hour], chosen[r.hour] = fitted[r.hour], (r.hour, r.round, r.loss, rounds)
        todo = [h for h in todo if h in chosen and rounds < most and rounds - chosen[h][1] < patience]
        rounds = min(2 * rounds, most)
    table = df.sparkSession.createDataFrame(sorted(chosen.values()), "hour int, round int, loss double, rounds int")
    return models, table


def fit_hourly_linear(
    df: DataFrame, features: Sequence[str], y: str, hours: Iterable[int] = range(24),
    horizons: Iterable[int] | None = None, regularisation: float = 0.0, l1_share: float = 0.0, parallel: int = 8,
) -> dict:
    """One linear model per hour (and horizon) on ``ln(y)``; no regularisation gives plain least squares."""
    keys = _groups(hours, horizons)
    by = _by(keys)
    train = stage(with_log_target(df, features, y).select(*by, "features", "label"), by=by)

    def estimator(hour):
        return LinearRegression(regParam=regularisation, elasticNetParam=l1_share, standardization=True)

    return _fit_groups(estimator, train, keys, parallel)


def score_hourly(df: DataFrame, models: dict, features: Sequence[str], out: str = "prediction") -> DataFrame:
    """Score each row with the model of its hour (and horizon); ``exp`` back to the load scale.

    The rows are staged first, so each model reads its own folder and the
    features are prepared once.
    """
    ready = _vectors(stage(df, by=_by(models)).select(df.columns), features)
    parts = [
        model.transform(_rows_of(ready, key)).withColumn(out, F.exp("prediction"))
        for key, model in sorted(models.items())
    ]
    return reduce(DataFrame.unionByName, parts).select(*df.columns, out)


def importances(df: DataFrame, models: dict, features: Sequence[str]) -> DataFrame:
    """``[horizon,] hour, feature, importance`` (shares that add up to 1 per model).

    The table has one row per model and feature, however large the data.
    """
    rows = [
        (*(key if isinstance(key, tuple) else (key,)), name, float(weight))
        for key, model in sorted(models.items())
        for name, weight in zip(features, model.featureImportances.toArray(), strict=True)
    ]
    schema = ", ".join(f"{c} int" for c in _by(models))
    return df.sparkSession.createDataFrame(rows, f"{schema}, feature string, importance double")


def log_losses(df: DataFrame, models: dict, features: Sequence[str], y: str) -> dict:
    """For each model the mean squared error of ``ln(y)`` after every round, the loss that training lowers."""
    by = _by(models)
    ready = stage(with_log_target(df, features, y).select(*by, "features", "label"), by=by)
    return {key: list(model.evaluateEachIteration(_rows_of(ready, key), "squared")) for key, model in sorted(models.items())}


def learning_curves(df: DataFrame, models: dict, features: Sequence[str], y: str) -> DataFrame:
    """``[horizon,] hour, round, loss`` of each model on ``df``: the RMSE of ``y`` in its own units after every round.

    Each tree adds one column; tasks add up the rounds of their rows with numpy, and one row per round and task is
    shuffled.
    """
    by = _by(models)
    ready = stage(with_log_target(df, features, y).select(*by, "features", F.col(y).cast("double").alias("_y")), by=by)

    def errors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                steps = np.cumsum(np.stack(batch["_steps"]), axis=1)
                squares = (batch["_y"].to_numpy(float)[:, None] - np.exp(steps)) ** 2
                yield pd.DataFrame({"round": np.arange(1, steps.shape[1] + 1, dtype="int32"),
                                    "n": len(batch), "squares": squares.sum(axis=0)})

    parts = []
    for key, model in sorted(models.items()):
        rows, steps = _rows_of(ready, key), []
        for i, (tree, weight) in enumerate(zip(model.trees, model.treeWeights, strict=True)):
            rows = tree.setPredictionCol(f"_p{i}").transform(rows)
            steps.append(F.col(f"_p{i}") * float(weight))
        curve = rows.select("_y", F.array(*steps).alias("_steps")).mapInPandas(errors, "round int, n bigint, squares double")
        curve = curve.groupBy("round").agg(F.sqrt(F.sum("squares") / F.sum("n")).alias("loss"))
        names = [F.lit(v).alias(c) for c, v in zip(by, key if isinstance(key, tuple) else (key,), strict=True)]
        parts.append(curve.select(*names, "round", "loss"))
    return reduce(DataFrame.unionByName, parts)


def best_rounds(curves: DataFrame, by: Sequence[str] = ("hour",), patience: int = 100) -> DataFrame:
    """``by, round, loss``: the round where training stops being worth it.

    Going up the rounds, the search ends when ``patience`` rounds in a row have not lowered the least loss so far; the
    round of that least loss is the result.  A curve has one row per round, so the window is as long as the training.
    """
    so_far = Window.partitionBy(*by).orderBy("round")
    least = curves.withColumn("_least", F.min("loss").over(so_far))
    first = least.withColumn("_at", F.min("round").over(Window.partitionBy(*by, "_least").orderBy("round")))
    waited = first.withColumn("_out", F.max((F.col("round") - F.col("_at") >= patience).cast("int")).over(so_far))
    return waited.where("_out = 0 AND loss = _least AND round = _at").groupBy(*by).agg(
        F.max("round").alias("round"), F.min("loss").alias("loss"))
