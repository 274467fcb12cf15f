"""Least squares for many groups at once.

Models are tables: ``keys..., n, intercept, coef_<x>...``.  Both ways read every row once and combine moments on the
map side, so a hot group is no slower than the others:

* Up to ``NARROW`` regressors, one aggregate gives the moments of every group and one array expression solves the
  normal equations: millions of small models cost no Python.
* Wider tables would need thousands of aggregates, and squaring them costs half the digits.  There, each task brings
  its own rows of a group to a triangle (QR), one triangle per group and task is shuffled, and triangles are merged by QR
  again.  Column pivoting finds the rank: of columns that explain each other, those with most variance of their own stay,
  wherever they stand in the list.

Both ways leave out rows where a column is null or NaN, and a model without keys is one over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A regressor whose remaining variance is below this share of its own variance
# is constant or a mix of the others; its coefficient is 0.
TOLERANCE = 1e-10
#: Widest table that is fitted by aggregates.
NARROW = 6
#: Numbers that a task holds in rows and triangles, and rows that it brings to a triangle at a time.
HELD, BLOCK = 1 << 22, 4096
#: Keys with a bounded number of values: models by these alone are a small table, however many rows they score.
POOLED = {"hour", "horizon", "fold"}


def _pairs(k: int):
    return [(i, j) for i in range(k) for j in range(i, k)]


def _target(y: str, log: bool) -> Column:
    value = F.col(y).cast("double")
    return F.when(value > 0, F.ln(value)) if log else value


def _plain(df: DataFrame, keys: Sequence[str], x: Sequence[str], y: str, log: bool) -> DataFrame:
    """``keys, _x0.., _y`` as numbers."""
    return df.select(*keys, *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(x)], _target(y, log).alias("_y"))


def _base(df: DataFrame, keys: Sequence[str], x: Sequence[str], y: str, log: bool) -> DataFrame:
    """``keys, _x0.., _y``: all null where any is null or NaN, so that aggregates leave the row out and its group stays."""
    names, wide = [f"_x{i}" for i in range(len(x))], _plain(df, keys, x, y, log)
    known = F.expr(" AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in [*names, "_y"]))
    return wide.select(*keys, *[F.when(known, F.col(c)).alias(c) for c in [*names, "_y"]])


# -- narrow tables -------------------------------------------------------------


def _solve(moments: DataFrame, keys: Sequence[str], x: Sequence[str]) -> DataFrame:
    """Coefficients from ``n, _mx<i>, _my, _a<i>_<j>`` (covariances) and ``_b<i>``: Gauss-Jordan steps over one array
    of rows, each with its right side at the end."""
    k = len(x)

    def a(i, j):
        return F.col(f"_a{i}_{j}") if i <= j else F.col(f"_a{j}_{i}")

    if not k:
        return moments.select(*keys, "n", F.col("_my").alias("intercept"))
    matrix = F.array(*[F.array(*[a(i, j) for j in range(k)], F.col(f"_b{i}")) for i in range(k)])
    own = F.array(*[a(i, i) for i in range(k)])

    def step(rows: Column, p: Column) -> Column:
        pivot = F.get(F.get(rows, p), p)
        usable = F.coalesce(pivot > TOLERANCE * F.get(own, p), F.lit(False))
        line = F.transform(F.get(rows, p), lambda v: F.when(usable, v / pivot).otherwise(0.0))
        return F.transform(rows, lambda row, i: F.when(i == p, line).otherwise(
            F.zip_with(row, line, lambda v, w: v - F.get(row, p) * w)))

    solved = F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), matrix, step)
    out = moments.withColumn("_c", F.transform(solved, lambda row: F.coalesce(F.get(row, F.lit(k)), F.lit(0.0))))
    level = F.col("_my")
    for i in range(k):
        level = level - F.get("_c", F.lit(i)) * F.col(f"_mx{i}")
    return out.select(*keys, "n", level.alias("intercept"), *[F.get("_c", F.lit(i)).alias(f"coef_{c}") for i, c in enumerate(x)])


def _moments(base: DataFrame, keys: Sequence[str], k: int, n: str = "n") -> DataFrame:
    return base.groupBy(*keys).agg(
        F.count("_y").alias(n),
        F.avg("_y").alias("_my"),
        *[F.avg(f"_x{i}").alias(f"_mx{i}") for i in range(k)],
        *[F.covar_pop(f"_x{i}", f"_x{j}").alias(f"_a{i}_{j}") for i, j in _pairs(k)],
        *[F.covar_pop(f"_x{i}", "_y").alias(f"_b{i}") for i in range(k)],
    )


# -- wide tables ---------------------------------------------------------------


Part = tuple[int, np.ndarray]  # number of rows, and the triangle of [1, x..., y]


def _triangle(blocks: Sequence[np.ndarray], width: int) -> np.ndarray:
    """The triangle of all rows together: its products are theirs."""
    out = np.zeros((width, width))
    found = np.linalg.qr(np.concatenate(blocks), mode="r") if any(map(len, blocks)) else out[:0]
    out[:len(found)] = found
    return out


def _added(parts: list[Part]) -> Part:
    return sum(n for n, _ in parts), _triangle([r for _, r in parts], len(parts[0][1]))


def _pivots(c: np.ndarray, own: np.ndarray, total: np.ndarray) -> list[int]:
    """Columns that are not a mix of the ones taken before: always the one that has kept the largest share of its own
    variance comes next, as long as that is over ``TOLERANCE``."""
    c, chosen = c.copy(), []
    # a constant column has nothing but rounding left
    usable = own > 1e-20 * total
    while len(chosen) < c.shape[1]:
        share = np.where(usable, (c * c).sum(axis=0) / np.where(usable, own, 1.0), 0.0)
        share[chosen] = 0.0
        best = int(np.argmax(share))
        if share[best] <= TOLERANCE:
            break
        chosen.append(best)
        unit = c[:, best] / np.sqrt((c[:, best] ** 2).sum())
        c -= np.outer(unit, unit @ c)
    return chosen


def _fitted(n: int, triangle: np.ndarray) -> list[float]:
    """Intercept and coefficients; 0 for columns that others explain."""
    k = len(triangle) - 2
    mean = triangle[0, 1:] / triangle[0, 0]
    c, right = triangle[1:, 1:k + 1], triangle[1:, k + 1]
    own = (c * c).sum(axis=0)
    chosen = _pivots(c, own, own + n * mean[:k] ** 2)
    coefficients = np.zeros(k)
    if chosen:
        scale = np.sqrt(own[chosen])
        coefficients[chosen] = np.linalg.lstsq(c[:, chosen] / scale, right, rcond=None)[0] / scale
    return [float(mean[k] - coefficients @ mean[:k]), *coefficients.tolist()]


def _groups_of(keys: Sequence[pa.Array], rows: int) -> tuple[list[tuple], list[np.ndarray]]:
    """The distinct keys of a batch, nulls as None, and the places of their rows."""
    codes, distinct = np.zeros(rows, np.int64), [()] if rows else []
    for column in keys:
        found = column.dictionary_encode(null_encoding="encode")
        values = found.dictionary.to_pylist()
        both, codes = np.unique(codes * len(values) + found.indices.to_numpy(), return_inverse=True)
        distinct = [(*distinct[c // len(values)], values[c % len(values)]) for c in both.tolist()]
    order = np.argsort(codes, kind="stable")
    return distinct, np.split(order, np.cumsum(np.bincount(codes, minlength=len(distinct)))[:-1])


def _partial_triangles(base: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """``keys, n, triangle`` of each group and task, from the rows of ``base`` where everything is known.

    A task gathers rows of all its groups up to ``HELD`` numbers before it brings them to triangles, so the triangle of a
    group is merged once for many rows, not with every batch.
    """
    keys, width = list(keys), k + 2

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Part] = {}
        waiting: dict[tuple, list[np.ndarray]] = {}
        kinds: list[pa.DataType] = []

        def bring() -> None:
            for key, blocks in waiting.items():
                rows = np.concatenate(blocks)
                for start in range(0, max(len(rows), 1), BLOCK):
                    own = rows[start:start + BLOCK]
                    n, before = held.get(key, (0, np.zeros((0, width))))
                    held[key] = n + len(own), _triangle([before, np.c_[np.ones(len(own)), own]], width)
            waiting.clear()

        def handed() -> pa.RecordBatch:
            columns = [pa.array([key[i] for key in held], kind) for i, kind in enumerate(kinds)]
            flat = np.concatenate([r.ravel() for _, r in held.values()])
            triangles = pa.ListArray.from_arrays(np.arange(len(held) + 1, dtype=np.int32) * width ** 2, flat)
            columns += [pa.array([n for n, _ in held.values()], pa.int64()), triangles]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, [*keys, "n", "triangle"])

        numbers = 0
        for batch in batches:
            kinds = [batch.column(i).type for i in range(len(keys))]
            values = batch.column(len(keys)).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), k + 1)
            known = ~np.isnan(values).any(axis=1)
            for key, at in zip(*_groups_of(batch.columns[:len(keys)], len(batch)), strict=True):
                waiting.setdefault(key, []).append(values[at[known[at]]])
            numbers += values.size
            if numbers + len(held.keys() | waiting.keys()) * width ** 2 > HELD:
                bring()
                numbers = 0
                if len(held) * width ** 2 > HELD // 2:
                    yield handed()
        bring()
        if held:
            yield handed()

    names = [*[f"_x{i}" for i in range(k)], "_y"]
    fields = [f for f in base.schema.fields if f.name in keys]
    fields.sort(key=lambda f: keys.index(f.name))
    schema = T.StructType([*fields, T.StructField("n", T.LongType()), T.StructField("triangle", T.ArrayType(T.DoubleType()))])
    # the numbers of a row go to Python as one array: a column for each would be converted on its own
    return base.select(*keys, F.array(*names).alias("_row")).mapInArrow(add_up, schema)


def _wide_models(partial: DataFrame, keys: Sequence[str], x: Sequence[str], fold: str | None = None) -> DataFrame:
    """One model per group of ``keys`` from the triangles, or with ``fold`` one per fold from all earlier folds."""
    k, keys = len(x), list(keys)

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        def parts(rows) -> list[Part]:
            return [(int(n), np.array(r).reshape(k + 2, k + 2)) for n, r in zip(rows["n"], rows["triangle"], strict=True)]

        head = [None if pd.isna(frame[c].iloc[0]) else frame[c].iloc[0] for c in keys]
        if fold is None:
            total = _added(parts(frame))
            rows = [(*head, total[0], *_fitted(*total))] if total[0] else []
        else:
            rows, before = [], None
            for day, own in frame.sort_values(fold).groupby(fold):
                if before is not None and before[0]:
                    rows.append((*head, day, before[0], *_fitted(*before)))
                before = _added([*([before] if before else []), *parts(own)])
        return pd.DataFrame(rows, columns=columns)

    columns = [*keys, *([fold] if fold else []), "n", "intercept", *[f"coef_{c}" for c in x]]
    kinds = {f.name: f for f in partial.schema.fields}
    schema = T.StructType([*[kinds[c] for c in columns if c in kinds],
                           *[T.StructField(c, T.DoubleType()) for c in columns if c not in kinds]])
    return partial.groupBy(*keys).applyInPandas(fit, schema)


# -- models ----------------------------------------------------------------------


def fit_grouped_linear(
    df: DataFrame, keys: Sequence[str], x: Sequence[str], y: str, log: bool = False
) -> DataFrame:
    """One least-squares model per group, on rows where all columns are known.

    ``log`` fits the logarithm of ``y`` (rows with ``y <= 0`` are left out).  A group without a known row has no model, a
    null key is a group like any other, and without keys there is one model.  NaN is not known.  A column that is constant
    or explained by others has the coefficient 0.
    """
    if len(x) > NARROW:
        return _wide_models(_partial_triangles(_plain(df, keys, x, y, log), keys, len(x)), keys, x)
    base = _base(df, keys, x, y, log).filter(F.col("_y").isNotNull())
    return _solve(_moments(base, keys, len(x)), keys, x).where("n > 0")


def fit_folds(
    df: DataFrame, keys: Sequence[str], x: Sequence[str], y: str, log: bool = False, unit: str = "month",
    folds: DataFrame | None = None,
) -> DataFrame:
    """One model per group and ``fold`` (first day of each ``unit``), fitted on all earlier rows.

    The folds are those of all rows of ``df``, also of rows whose target is not known, and those of ``folds``
    (``keys, fold``).  A fold with nothing known before it has no model.

    Moments add up: they are taken once per month and summed over the months
    before each fold.  Every row is read once, however many folds there are.
    """
    k, keys = len(x), list(keys)
    folded = df.withColumn("fold", F.trunc("date", unit))
    if k > NARROW:
        partial = _partial_triangles(_plain(folded, [*keys, "fold"], x, y, log), [*keys, "fold"], k)
        if folds is not None:
            none = F.array_repeat(F.lit(0.0), (k + 2) ** 2)
            partial = partial.unionByName(folds.select(
                *keys, "fold", F.lit(0).cast("long").alias("n"), none.alias("triangle")))
        return _wide_models(partial, keys, x, "fold")
    base = _base(folded, [*keys, "fold"], x, y, log)
    names = ["_y", *[f"_x{i}" for i in range(k)]]
    pairs = [(f"_x{i}", f"_x{j}", f"_a{i}_{j}") for i, j in _pairs(k)]
    pairs += [(f"_x{i}", "_y", f"_b{i}") for i in range(k)]
    monthly = _moments(base, [*keys, "fold"], k, "_n")
    if folds is not None:
        rest = [c for c in monthly.columns if c not in (*keys, "fold", "_n")]
        empty = folds.select(*keys, "fold", F.lit(0).cast("long").alias("_n"), *[F.lit(None).cast("double").alias(c) for c in rest])
        monthly = monthly.unionByName(empty).groupBy(*keys, "fold").agg(
            F.sum("_n").alias("_n"), *[F.max(c).alias(c) for c in rest])
    # distances from the mean of the monthly means keep the sums small
    group = Window.partitionBy(*keys)
    centred = monthly.withColumns({f"_g{c}": F.avg(f"_m{c[1:]}").over(group) for c in names})
    centred = centred.withColumns({f"_d{c}": F.col(f"_m{c[1:]}") - F.col(f"_g{c}") for c in names})
    earlier = group.orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)
    n = F.col("_n")
    sums = {"n": F.sum(n).over(earlier)}
    sums |= {f"_s{c}": F.sum(n * F.col(f"_d{c}")).over(earlier) for c in names}
    sums |= {
        f"_q{out}": F.sum(n * (F.col(out) + F.col(f"_d{p}") * F.col(f"_d{q}"))).over(earlier)
        for p, q, out in pairs
    }
    total = centred.withColumns(sums).filter(F.col("n") > 0)
    mean = {c: F.col(f"_s{c}") / F.col("n") for c in names}
    moments = total.select(
        *keys, "fold", "n",
        (F.col("_g_y") + mean["_y"]).alias("_my"),
        *[(F.col(f"_g_x{i}") + mean[f"_x{i}"]).alias(f"_mx{i}") for i in range(k)],
        *[(F.col(f"_q{out}") / F.col("n") - mean[p] * mean[q]).alias(out) for p, q, out in pairs],
    )
    return _solve(moments, [*keys, "fold"], x)


def linear_value(x: Sequence[str], log: bool = False) -> Column:
    """The model value of a row that holds the model's columns."""
    value = F.col("intercept")
    for c in x:
        value = value + F.col(f"coef_{c}") * F.col(c)
    return F.exp(value) if log else value


def score(
    df: DataFrame, model: DataFrame, keys: Sequence[str], x: Sequence[str],
    log: bool = False, out: str = "prediction",
) -> DataFrame:
    """Route each row to the model of its group; rows without a model get null.

    Models by calendar keys alone are few: they are sent to the rows, which may be
    wide and have few keys, and no row is shuffled.  Other model tables grow with the
    number of series, so Spark chooses the join from their size.
    """
    table = model.select(*keys, "intercept", *[f"coef_{c}" for c in x])
    if keys and POOLED.issuperset(keys):
        table = F.broadcast(table)
    joined = df.join(table, list(keys), "left").withColumn(out, linear_value(x, log))
    return joined.select(*df.columns, out)
