"""Stored ensembles as tables: counts by a walk over the trees, scores by Spark ML, routes and stopping by hand."""

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F

from gridcast.operators import boosted, trees
from gridcast.sources.store import load_models, save_models

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def panel(spark):
    draw, rows = random.Random(1), []
    for k in range(40):
        for hour in (3, 7):
            for site in range(6):
                a, b = draw.uniform(0, 10), draw.uniform(0, 10)
                rows.append((site, date(2024, 1, 1) + timedelta(k), hour, a, b, float(k % 7), 50 + 3 * a + hour * (b > 5) + draw.gauss(0, 1)))
    return spark.createDataFrame(rows, "site int, date date, hour int, a double, b double, c double, load double").coalesce(2).cache()


@pytest.fixture(scope="module")
def store(panel, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store"))
    models = boosted.fit_issued_gbt(panel, FEATURES, "load", ["2024-01-15", "2024-01-29"], hours=[3, 7], maxIter=3, maxDepth=2, stepSize=0.3)
    save_models(models, path, by=("issued", "hour"))
    return path, models


def nodes_of(spark, path):
    return trees.read_nodes(spark, path, {"issued": "date", "hour": "int"})


def walk(node, found):
    if node.numDescendants() > 0:
        found[node.split().featureIndex()] += 1
        walk(node.leftChild(), found)
        walk(node.rightChild(), found)


def test_split_counts_are_those_of_a_walk(spark, store):
    path, models = store
    got = trees.split_counts(nodes_of(spark, path), FEATURES, ["issued", "hour"]).collect()
    for (issue, hour), model in models.items():
        found = Counter()
        for tree in model.trees:
            walk(tree._java_obj.rootNode(), found)
        own = sorted((r for r in got if str(r.issued) == issue and r.hour == hour), key=lambda r: r.place)
        assert {r.feature: r.splits for r in own} == {FEATURES[k]: n for k, n in found.items()}
        assert [r.place for r in own] == list(range(1, len(own) + 1))
        assert [(-r.splits, r.feature) for r in own] == sorted((-r.splits, r.feature) for r in own)
        assert abs(sum(r.share for r in own) - 1) < 1e-12 and all(r.share == r.splits / sum(found.values()) for r in own)


@pytest.mark.parametrize("limits", [{}, {"sent_nodes": 0, "part_rows": 50}])
def test_scores_are_those_of_the_models(spark, panel, store, limits):
    path, models = store
    extra = panel.select("site", "date", "hour", *FEATURES).withColumn("note", F.lit("x").try_cast("string")).withColumn("note", F.when(F.col("hour") >= 0, F.col("note")))
    odd = spark.createDataFrame([(99, date(2024, 2, 1), 3, None, 1.0, 1.0, None), (98, date(2024, 2, 1), 23, 1.0, 1.0, 1.0, "no model")], extra.schema)
    rows = trees.route_to_issue(extra.union(odd), nodes_of(spark, path).select("issued", "hour").distinct(), ["hour"])
    got = trees.score_trees(rows, nodes_of(spark, path), FEATURES, ["issued", "hour"], **limits)
    assert got.columns == [*extra.columns, "issued", "prediction"]
    found = {(r.site, r.date, r.hour): r for r in got.collect()}
    assert len(found) == extra.count() + 2
    ready = boosted._vectors(extra, FEATURES)
    for (issue, hour), model in models.items():
        for r in model.transform(ready.where(F.col("hour") == hour)).withColumn("p", F.exp("prediction")).collect():
            mine = found[(r.site, r.date, r.hour)]
            expected = "2024-01-29" if r.date >= date(2024, 1, 29) else "2024-01-15" if r.date >= date(2024, 1, 15) else None
            assert (str(mine.issued) if mine.issued else None) == expected
            if expected is None:
                assert mine.prediction is None
            elif expected == issue:
                assert mine.prediction == pytest.approx(r.p, rel=1e-12)
    assert found[(99, date(2024, 2, 1), 3)].prediction is None and found[(98, date(2024, 2, 1), 23)].prediction is None


def test_one_scan_for_all_models(spark, panel, store):
    path, _ = store
    rows = trees.route_to_issue(panel, nodes_of(spark, path).select("issued", "hour").distinct(), ["hour"])
    plan = trees.score_trees(rows, nodes_of(spark, path), FEATURES, ["issued", "hour"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("InMemoryTableScan") == 1 and "Union" not in plan


def test_each_issue_knows_earlier_rows_only(spark, panel, store):
    path, _ = store
    roots = nodes_of(spark, path).where("tree = 0 AND node = 0").collect()
    assert len(roots) == 4
    for r in roots:
        n = panel.where((F.col("date") < F.lit(r.issued)) & (F.col("hour") == r.hour)).count()
        assert r.samples <= n and r.samples > 0.6 * n  # the day-ahead settings take a sample of the rows


def test_one_model_is_replaced_and_the_others_stay(spark, panel, store, tmp_path):
    _, models = store
    path = str(tmp_path / "again")
    save_models(models, path, by=("issued", "hour"))
    before = {(str(r.issued), r.hour): r.n for r in nodes_of(spark, path).groupBy("issued", "hour").agg(F.count("*").alias("n")).collect()}
    key = ("2024-01-29", 7)
    save_models({key: boosted.fit_hourly_gbt(panel, FEATURES, "load", hours=[7], maxIter=1, maxDepth=1)[7]}, path, by=("issued", "hour"))
    after = {(str(r.issued), r.hour): r.n for r in nodes_of(spark, path).groupBy("issued", "hour").agg(F.count("*").alias("n")).collect()}
    assert after == {**before, key: 3}
    back = load_models(GBTRegressionModel, path, [key], by=("issued", "hour"))
    assert back[key].getNumTrees == 1


def test_training_ends_by_the_held_out_error(spark, panel):
    late = F.col("date") >= F.lit("2024-02-01").cast("date")
    how = dict(hours=[3], maxDepth=3, stepSize=0.9, subsamplingRate=1.0)
    models, rounds = boosted.fit_until_best(panel, FEATURES, "load", late, patience=3, first=2, maxIter=16, **how)
    longest = boosted.fit_hourly_gbt(panel.where(~late), FEATURES, "load", "climate", maxIter=16, **how)
    curves = {(r.hour, r.round): r.loss for r in boosted.learning_curves(panel.where(late), longest, FEATURES, "load").collect()}
    for r in rounds.collect():
        losses = [curves[(r.hour, k)] for k in range(1, r.rounds + 1)]
        best = next(k for k in range(1, 17) if k == 16 or curves[(r.hour, k)] < min(curves[(r.hour, j)] for j in range(k + 1, min(k + 3, 16) + 1))
                    and curves[(r.hour, k)] == min(losses[:k]))
        assert 1 <= r.round < r.rounds <= 16 and r.rounds - r.round >= 3
        assert r.loss == pytest.approx(min(losses[:r.round + 3])) and r.round == best
        assert models[r.hour].getNumTrees == r.rounds


def test_first_rounds_cut_an_ensemble(spark, panel, store):
    path, models = store
    rounds = spark.createDataFrame([(date(2024, 1, 15), 3, 2)], "issued date, hour int, round int")
    cut = trees.first_rounds(nodes_of(spark, path), rounds, ["issued", "hour"])
    assert {r.tree for r in cut.select("tree").distinct().collect()} == {0, 1}
    assert cut.select("issued", "hour").distinct().count() == 1


def test_a_group_without_rows_has_no_model(spark):
    rows = [(j, h, float(i), 2.0 + i) for i in range(6) for j, h in ((1, 0), (1, 1), (2, 1))] + [(2, 0, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "horizon int, hour int, a double, load double")
    models = boosted.fit_hourly_gbt(df, ["a"], "load", hours=(0, 1), horizons=(1, 2, 3), maxIter=1, subsamplingRate=1.0)
    assert sorted(models) == [(1, 0), (1, 1), (2, 1)]
    assert sorted(boosted.fit_hourly_linear(df.where("horizon = 2"), ["a"], "load", hours=(0, 1, 2))) == [1]
