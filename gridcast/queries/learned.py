"""Spark ML regressors per hour."""

from __future__ import annotations

import uuid

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridcast.operators.boosted import (
    fit_hourly_gbt,
    fit_hourly_linear,
    fit_issued_gbt,
    fit_until_best,
    importances,
    learning_curves,
    log_losses,
    score_hourly,
)
from gridcast.operators.kpi import kpis
from gridcast.operators.climate import neutral_weather
from gridcast.operators.splits import split_day, split_window
from gridcast.operators.trees import first_rounds, read_nodes, route_to_issue, score_trees, split_counts
from gridcast.plans.features import MULTI_DAY_TEMPERATURE_LAGS, feature_columns, hourly_features
from gridcast.plans.forecasts import split_off_weather_boosted
from gridcast.queries.registry import grid_sql, iso, load_profiles, query, rounded, temperature_profiles
from gridcast.queries.scoring import CUT, PREPARED, PREPARED_SQL, prepared
from gridcast.session import stage, staging_root
from gridcast.sources.store import load_models, save_models

#: Rounds of the registered query.  The forecasts of ``SETTINGS`` take 500 and 1,200 rounds for each of 24 models, which
#: is hours of work on a few cores; a job of that size is not registered.
FIRST_ROUNDS = 3


@query(
    "gbt_first_rounds",
    f"""WITH {grid_sql()}
SELECT h AS hour, 1 AS models, 1 AS shares_add_up, 1 AS splits_add_up, 1 AS in_order, 1 AS loss_falls, 1 AS curve_fits,
       1 AS reads_back,
       count(*) FILTER (WHERE d = DATE '2024-01-25') AS predicted FROM grid GROUP BY 1""",
)
def gbt_first_rounds(spark, folder):
    """The first rounds of 24 boosted models on every column of the feature
    table, pooled over the series, by the long_term settings without subsampling and without early stopping (M7: its curves
    only); facts that hold whatever the trees are."""
    table, features = _features(spark, folder)
    train, test = split_day(table, "2024-01-25")
    models = fit_hourly_gbt(train, features, "load", kind="long_term", maxIter=FIRST_ROUNDS, subsamplingRate=1.0)
    path = _stored(spark, models, ("hour",))
    loaded, nodes = load_models(GBTRegressionModel, path, models), read_nodes(spark, path, {"hour": "int"})
    shares = importances(train, loaded, features).groupBy("hour").agg(F.sum("importance").alias("s"))
    # a binary tree has one split less than leaves; places go down from the most splits
    inner = nodes.groupBy("hour").agg((F.count_if(F.col("feature") < 0) - F.count_if(F.col("node") == 0)).alias("inner"))
    counts = split_counts(nodes, features, ["hour"])
    above = Window.partitionBy("hour").orderBy("place")
    ordered = counts.withColumn("fits", F.coalesce(F.lag("splits").over(above) >= F.col("splits"), F.col("place") == 1))
    splits = ordered.groupBy("hour").agg(F.sum("splits").alias("splits"), F.sum("share").alias("share"), F.every("fits").alias("fits"))
    added = splits.join(inner, "hour").select(
        "hour", ((F.col("splits") == F.col("inner")) & (F.abs(F.col("share") - 1) < 1e-9)).cast("int").alias("splits_add_up"),
        F.col("fits").cast("int").alias("in_order"))
    curves = learning_curves(train, models, features, "load")
    last = kpis(score_trees(train.where("load > 0"), nodes, features, ["hour"]), ["hour"]).select("hour", "rmse")
    fits = curves.where(F.col("round") == FIRST_ROUNDS).join(last, "hour").select(
        "hour", (F.abs(F.col("loss") - F.col("rmse")) <= 1e-9 * (1 + F.col("rmse"))).cast("int").alias("curve_fits"))
    falls = [(hour, int(losses == sorted(losses, reverse=True))) for hour, losses in log_losses(train, models, features, "load").items()]
    loss = fits.join(spark.createDataFrame(falls, "hour int, loss_falls int"), "hour")
    again = score_trees(test, nodes, features, ["hour"]).groupBy("hour").agg(F.sum("prediction").alias("b"))
    once = score_hourly(test, models, features).groupBy("hour").agg(
        F.sum("prediction").alias("a"), F.count("prediction").alias("predicted"))
    out = shares.join(added, "hour").join(loss, "hour").join(once, "hour").join(again, "hour")
    return out.select(
        "hour", F.lit(1).alias("models"), (F.abs(F.col("s") - 1) < 1e-9).cast("int").alias("shares_add_up"), "splits_add_up",
        "in_order", "loss_falls", "curve_fits",
        (F.abs(F.col("a") - F.col("b")) <= 1e-9 * F.abs("a")).cast("int").alias("reads_back"), "predicted")


def _stored(spark, models, by) -> str:
    path = f"{staging_root(spark)}/models-{uuid.uuid4().hex}"
    save_models(models, path, by=by)
    return path


def _features(spark, folder):
    """The feature table of all series, staged once, and its regressors."""
    wide = hourly_features(load_profiles(spark, folder), ["series_id"], temperature_profiles(spark, folder))
    return stage(wide), feature_columns(wide)


#: First day with all lags of the feature table, in days after the first day of the events.
FIRST_DAY = 15
ISSUES = ("2024-01-20", "2024-01-25")
_KNOWN = f"""{grid_sql()}, first AS (SELECT min(CAST(ts AS DATE)) + {FIRST_DAY} AS day FROM events),
known AS (SELECT grid.* FROM grid, first WHERE d >= day)"""


@query(
    "boosted_walk_forward",
    f"""WITH {_KNOWN},
issues AS (SELECT unnest([{", ".join(f"DATE '{i}'" for i in ISSUES)}]) AS issued),
fits AS (SELECT issued, h, count(*) AS samples, avg(ln(load)) AS level FROM known JOIN issues ON d < issued WHERE load > 0
         GROUP BY issued, h),
routed AS (SELECT h, (SELECT max(issued) FROM issues WHERE issued <= d) AS issued, d FROM known)
SELECT CAST(issued AS VARCHAR) AS issued, h AS hour, count(*) AS n, count(*) AS predicted, CAST(min(d) AS VARCHAR) AS first_day,
       CAST(max(d) AS VARCHAR) AS last_day, any_value(samples) AS samples, round(any_value(level), 6) AS level
FROM routed JOIN fits USING (issued, h) GROUP BY issued, h""",
)
def boosted_walk_forward(spark, folder):
    """Boosted models renewed at two issue dates, by the day_ahead settings without subsampling and cut
    to two rounds, stored by date and hour; every later row is routed to the latest model issued by its day and scored in one
    scan.  The first tree's root holds the mean of the logarithms that its model was fitted on, which SQL takes from the rows."""
    table, features = _features(spark, folder)
    models = fit_issued_gbt(table, features, "load", ISSUES, maxIter=2, subsamplingRate=1.0)
    nodes = read_nodes(spark, _stored(spark, models, ("issued", "hour")), {"issued": "date", "hour": "int"})
    by = ["issued", "hour"]
    routed = route_to_issue(table, nodes.select(*by).distinct(), ["hour"]).where("issued IS NOT NULL")
    scored = score_trees(routed, nodes, features, by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count("prediction").alias("predicted"), F.min("date").alias("first_day"), F.max("date").alias("last_day"))
    roots = nodes.where("tree = 0 AND node = 0").select(*by, "samples", F.round("value", 6).alias("level"))
    return scored.join(roots, by).select(iso("issued").alias("issued"), "hour", "n", "predicted", iso("first_day").alias("first_day"),
                                         iso("last_day").alias("last_day"), "samples", "level")


HELD_OUT = "2024-01-25"


@query(
    "early_stopping",
    f"""WITH {_KNOWN}
SELECT h AS hour, count(*) FILTER (WHERE d >= DATE '{HELD_OUT}' AND load > 0) AS held_out, 1 AS ended, 1 AS loss_is_kept
FROM known GROUP BY h""",
)
def early_stopping(spark, folder):
    """Training of 24 boosted models by the climate settings, ended by the error in load units on the last days; the
    ensembles cut to their best round give that error again, scored in one scan."""
    table, features = _features(spark, folder)
    late = F.col("date") >= F.lit(HELD_OUT).cast("date")
    models, rounds = fit_until_best(table, features, "load", late, patience=1, first=2, maxIter=4, stepSize=0.5)
    nodes = first_rounds(read_nodes(spark, _stored(spark, models, ("hour",)), {"hour": "int"}), rounds, ["hour"])
    again = kpis(score_trees(table.where(late & (F.col("load") > 0)), nodes, features, ["hour"]), ["hour"])
    ended = (F.col("round") >= 1) & (F.col("round") <= F.col("rounds")) & (F.col("rounds") <= 4) & (
        (F.col("rounds") == 4) | (F.col("rounds") > F.col("round")))
    return again.join(rounds, "hour").select(
        "hour", F.col("n").alias("held_out"), ended.cast("int").alias("ended"),
        (F.abs(F.col("loss") - F.col("rmse")) <= 1e-9 * (1 + F.col("rmse"))).cast("int").alias("loss_is_kept"))


CLIMATE_WINDOW = ("2024-01-16", "2024-01-31")


@query(
    "boosted_climate_part",
    f"""WITH {grid_sql()}, first AS (SELECT min(t) + INTERVAL {max(MULTI_DAY_TEMPERATURE_LAGS)} HOUR AS hour FROM grid),
known AS (SELECT grid.* FROM grid, first WHERE t >= hour AND d < DATE '{CLIMATE_WINDOW[1]}')
SELECT h AS hour, count(*) FILTER (WHERE load > 0) AS samples, round(avg(ln(load)) FILTER (WHERE load > 0), 6) AS level,
       count(*) FILTER (WHERE d >= DATE '{CLIMATE_WINDOW[0]}') AS n,
       round(sum(load) FILTER (WHERE d >= DATE '{CLIMATE_WINDOW[0]}'), 3) AS load, 1 AS as_the_models_say, 1 AS weather_counts
FROM known GROUP BY h""",
)
def boosted_climate_part(spark, folder):
    """The load due to weather by 24 boosted models on the climate job's columns (its settings
    at stepSize 0.5, four rounds, no subsampling).  SQL has the rows, the training rows and their mean logarithm; every part
    is also computed again by Spark ML's own models on rows with 16 degrees in all weather columns."""
    wide = stage(hourly_features(
        load_profiles(spark, folder), ["series_id"], temperature_profiles(spark, folder), lags=(), stats=(),
        temperature_lags=MULTI_DAY_TEMPERATURE_LAGS, temperature_days=(), same_hour_temperature=True))
    features, store = feature_columns(wide), f"{staging_root(spark)}/models-{uuid.uuid4().hex}"
    parts = split_off_weather_boosted(wide, ["series_id"], *CLIMATE_WINDOW, features, store, maxIter=4, stepSize=0.5,
                                      subsamplingRate=1.0)
    models = load_models(GBTRegressionModel, store, range(24))
    _, test = split_window(wide, *CLIMATE_WINDOW)
    again = score_hourly(neutral_weather(test), models, features, "neutral").select("series_id", "date", "hour", "neutral")
    own = score_trees(test, read_nodes(spark, store, {"hour": "int"}), features, ["hour"], "own")
    again = again.join(own.select("series_id", "date", "hour", "own"), ["series_id", "date", "hour"])
    rest = F.greatest(F.col("load") - F.col("neutral"), F.lit(0.0))
    same = F.abs(F.col("climate_part") - rest) <= 1e-9 * (1 + F.col("load"))
    facts = parts.join(again, ["series_id", "date", "hour"]).groupBy("hour").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("load"), 3).alias("load"), F.every(same).cast("int").alias("as_the_models_say"),
        F.some(F.abs(F.col("own") - F.col("neutral")) > 0).cast("int").alias("weather_counts"))
    roots = read_nodes(spark, store, {"hour": "int"}).where("tree = 0 AND node = 0").select(
        "hour", "samples", F.round("value", 6).alias("level"))
    return facts.join(roots, "hour").select("hour", "samples", "level", "n", "load", "as_the_models_say", "weather_counts")


@query(
    "boosted_horizons",
    f"""WITH {grid_sql()}, first AS (SELECT min(CAST(ts AS DATE)) + {FIRST_DAY} AS day FROM events),
last AS (SELECT max(d) AS day FROM grid), js AS (SELECT CAST(unnest(generate_series(1, 14)) AS INTEGER) AS j),
known AS (SELECT grid.*, j FROM grid, js, first WHERE d >= first.day + (j - 1))
SELECT j AS horizon, h AS hour, count(*) FILTER (WHERE load > 0 AND d < day) AS samples,
       round(avg(ln(load)) FILTER (WHERE load > 0 AND d < day), 6) AS level, count(*) FILTER (WHERE d = day) AS predicted
FROM known, last GROUP BY 1, 2""",
)
def boosted_horizons(spark, folder):
    """One boosted model for each of 14 horizons and 24 hours, 336 in all, by the multi_day settings
    cut to one round and without subsampling, on every column of the noised 14-day feature table; the last day is scored
    in one scan by all horizons that reach it.  A horizon and hour without load to learn from has no model: its rows are counted
as they are."""
    wide = stage(hourly_features(
        load_profiles(spark, folder), ["series_id"], temperature_profiles(spark, folder), horizons=14, noise_seed=1304,
        temperature_lags=MULTI_DAY_TEMPERATURE_LAGS))
    features, by = feature_columns(wide), ["horizon", "hour"]
    wide = stage(wide)
    train, test = split_day(wide, wide.agg(F.max("date")).first()[0].isoformat())
    models = fit_hourly_gbt(train, features, "load", kind="multi_day", horizons=range(1, 15), maxIter=1, subsamplingRate=1.0)
    nodes = read_nodes(spark, _stored(spark, models, tuple(by)), {"horizon": "int", "hour": "int"})
    scored = score_trees(test, nodes, features, by).groupBy(*by).agg(
        F.count("prediction").alias("predicted"), F.count(F.lit(1)).alias("n"))
    roots = nodes.where("tree = 0 AND node = 0").select(*by, "samples", F.round("value", 6).alias("level"))
    predicted = F.when(F.col("samples").isNull(), F.col("n")).otherwise(F.col("predicted"))
    return wide.select(*by).distinct().join(roots, by, "left").join(scored, by, "left").select(
        *by, F.coalesce("samples", F.lit(0)).alias("samples"), "level", F.coalesce(predicted, F.lit(0)).alias("predicted"))


@query(
    "linear_ml",
    f"""WITH {PREPARED_SQL},
pred AS (SELECT h, load + 1 AS load, exp(c{"".join(f" + c{i} * x{i}" for i in range(len(PREPARED)))}) AS p
         FROM wide JOIN solved USING (h) WHERE d = DATE '{CUT}')
SELECT h AS hour, count(*) AS n, round(sqrt(avg((load - p) ** 2)), 3) AS rmse,
       round(avg(abs(load - p) / nullif(load, 0)), 5) AS mape FROM pred GROUP BY 1""",
)
def linear_ml(spark, folder):
    """M6: plain least squares per hour with the ML estimator on load + 1, errors per hour of the test day."""
    shifted = (F.col("load") + 1).alias("load")
    table = stage(prepared(spark, folder).select("series_id", "date", "hour", shifted, *PREPARED))
    train, test = split_day(table, CUT)
    models = fit_hourly_linear(train, PREPARED, "load")
    return rounded(rounded(kpis(score_hourly(test, models, PREPARED), ["hour"]), 3, "rmse"), 5, "mape")
