"""Narrow and wide fits on the same rows, rank by pivoting, odd rows."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridcast.operators import regression


def table(spark, rows, x, extra=""):
    return spark.createDataFrame(rows, f"k int, {', '.join(f'{c} double' for c in x)}, y double{extra}")


def models(df, keys, x, monkeypatch, narrow):
    monkeypatch.setattr(regression, "NARROW", narrow)
    return sorted((tuple(r) for r in regression.fit_grouped_linear(df, keys, x, "y").collect()), key=str)


@pytest.mark.parametrize("keys", [["k"], []])
def test_both_ways_agree(spark, monkeypatch, keys):
    draw = np.random.default_rng(1)
    x = ["a", "b", "c"]
    rows = [(int(k) if k else None, *map(float, v), float(v @ [1, -2, .5] + draw.normal() + (k or 0)))
            for k in (None, 1, 2) for v in draw.normal(5, 2, (40, 3))]
    rows += [(1, float("nan"), 1.0, 1.0, 1.0), (2, 1.0, 1.0, 1.0, float("nan")), (1, None, 1.0, 1.0, 1.0), (2, 1.0, 1.0, 1.0, None),
             (7, None, 1.0, 1.0, 1.0), (8, 1.0, 2.0, 3.0, 4.0)]
    df = table(spark, rows, x).repartition(4)
    narrow, wide = (models(df, keys, x, monkeypatch, n) for n in (8, 0))
    assert len(narrow) == len(wide) == (4 if keys else 1)  # a group without a known row has no model
    for a, b in zip(narrow, wide, strict=True):
        assert a[:len(keys) + 1] == b[:len(keys) + 1]
        assert a[len(keys) + 1:] == pytest.approx(b[len(keys) + 1:], abs=1e-8)
    assert models(df.where("false"), ["k"], x, monkeypatch, 0) == models(df.where("false"), ["k"], x, monkeypatch, 8) == []
    assert models(df.where("false"), [], x, monkeypatch, 0) == models(df.where("false"), [], x, monkeypatch, 8) == []


def test_rank_does_not_depend_on_the_order_of_columns(spark, monkeypatch):
    """One-hot columns, a sum of others, a constant: the fitted values are those of the projection, in any order."""
    draw = np.random.default_rng(2)
    n = 200
    day = draw.integers(0, 4, n)
    a, b = draw.normal(1e4, 1, n), draw.normal(0, 1e-3, n)
    columns = {**{f"d{j}": (day == j).astype(float) for j in range(4)}, "a": a, "b": b, "both": a + 1000 * b, "one": np.full(n, 7.3)}
    y = a * 2 + 500 * b + day + draw.normal(0, 0.1, n)
    full = np.column_stack([np.ones(n), *columns.values()])
    want = full @ np.linalg.lstsq(full, y, rcond=1e-12)[0]
    rank = 5  # three of four days, and two of a, b and both
    for names in (list(columns), list(columns)[::-1], [*list(columns)[4:], *list(columns)[:4]]):
        df = table(spark, [(1, *[float(columns[c][i]) for c in names], float(y[i])) for i in range(n)], names).repartition(5)
        monkeypatch.setattr(regression, "NARROW", 0)
        model = regression.fit_grouped_linear(df, ["k"], names, "y").first()
        coefficients = [model[f"coef_{c}"] for c in names]
        assert sum(c != 0 for c in coefficients) == rank and model["coef_one"] == 0
        got = model.intercept + sum(c * columns[name] for c, name in zip(coefficients, names, strict=True))
        assert np.abs(got - want).max() < 1e-6


def test_triangles_keep_the_digits_that_squares_lose():
    """Two columns that differ by one part in 10^6: their difference decides."""
    draw = np.random.default_rng(3)
    a = draw.normal(0, 1, 500)
    b = a + 1e-4 * draw.normal(0, 1, 500)
    y = 3 * a + 1000 * (b - a)
    parts = [(100, regression._triangle([np.c_[np.ones(100), a[i:i + 100], b[i:i + 100], y[i:i + 100]]], 4)) for i in range(0, 500, 100)]
    level, first, second = regression._fitted(*regression._added(parts))
    assert abs(level) < 1e-8 and abs(first + 997) < 1e-6 and abs(second - 1000) < 1e-6


def test_fewer_rows_than_columns(spark, monkeypatch):
    names = [f"c{i}" for i in range(12)]
    draw = np.random.default_rng(4)
    values = draw.normal(0, 1, (5, 13))
    df = table(spark, [(1, *map(float, v)) for v in values], names)
    model = regression.fit_grouped_linear(df, ["k"], names, "y").first()
    got = model.intercept + values[:, :12] @ [model[f"coef_{c}"] for c in names]
    assert np.abs(got - values[:, 12]).max() < 1e-8  # five rows are met exactly


def test_folds_agree(spark, monkeypatch):
    draw = np.random.default_rng(5)
    rows = [(int(k % 2), f"2024-{1 + k // 40:02d}-05", *map(float, draw.normal(0, 1, 3))) for k in range(160)]
    df = spark.createDataFrame(rows, "k int, day string, a double, b double, y double").withColumn("date", F.col("day").cast("date"))

    def run(narrow):
        monkeypatch.setattr(regression, "NARROW", narrow)
        return sorted(map(tuple, regression.fit_folds(df, ["k"], ["a", "b"], "y").collect()))

    for a, b in zip(run(8), run(0), strict=True):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], abs=1e-9)


@pytest.mark.parametrize("x", [["a", "b"], [f"x{i}" for i in range(9)]])
def test_rows_are_not_shuffled_to_pooled_models(spark, x):
    """24 models, narrow or wide, are sent to the rows, before anything is known of the table's size; rows of a null key or
    without a model stay."""
    draw = np.random.default_rng(4)
    rows = [(i % 5 if i % 7 else None, *map(float, draw.normal(size=len(x))), float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, f"hour int, {', '.join(f'{c} double' for c in x)}, y double")
    scored = regression.score(df, regression.fit_grouped_linear(df.where("hour < 4"), ["hour"], x, "y"), ["hour"], x)
    plan = scored._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    got = scored.collect()
    assert len(got) == 200 and all((r.prediction is None) == (r.hour is None or r.hour == 4) for r in got)


def test_groups_of_a_task_meet_over_many_batches(spark):
    """Rows of a group gather over batches; null keys and dates as keys; a group without a known row has no model."""
    draw = np.random.default_rng(6)
    x = [f"x{i}" for i in range(8)]
    days = [None, dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
    rows = [(days[i % 3], "s" if i % 2 else None, *map(float, draw.normal(size=8)), float(draw.normal())) for i in range(300)]
    rows += [(days[1], "none", *[1.0] * 8, None)]
    df = spark.createDataFrame(rows, f"d date, s string, {', '.join(f'{c} double' for c in x)}, y double").coalesce(1)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size, None)
    spark.conf.set(size, "7")
    try:
        found = {(r.d, r.s): r for r in regression.fit_grouped_linear(df, ["d", "s"], x, "y").collect()}
    finally:
        spark.conf.unset(size) if before is None else spark.conf.set(size, before)
    assert len(found) == 6 and all(r.n == 50 for r in found.values())
    for key, r in found.items():
        own = np.array([v[2:] for v in rows[:300] if v[:2] == key])
        want = np.linalg.lstsq(np.c_[np.ones(50), own[:, :8]], own[:, 8], rcond=None)[0]
        assert [r.intercept, *[r[f"coef_{c}"] for c in x]] == pytest.approx(want, abs=1e-9)
