"""Stored tree ensembles as tables: nodes are rows.

A model folder of Spark ML is read as it lies there, all models of a store in one scan, without a model object for each.
The node table gives importances as split counts, and it scores: every row finds the model of its own key, so one scan
of the rows serves any number of models.  Models that fit a size bound go to all tasks; larger stores are dealt by key to
the rows, whose keys are cut into parts, so that a key with very many rows has many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Nodes that are sent to every task at most (40 bytes each), and rows of a part when models are dealt by key.
SENT_NODES, PART_ROWS = 1 << 20, 1 << 16


def read_nodes(spark: SparkSession, path: str, by: dict[str, str]) -> DataFrame:
    """``by..., tree, node, feature, threshold, left, right, value, weight, samples, gain`` of all models under ``path``.

    ``by`` names the folder levels above a model and their types: ``{"issued": "date", "hour": "int"}`` for
    ``issued=2024-01-15/hour=7``.  ``feature`` is -1 in a leaf.  Splits by category are refused.
    """
    levels = "/".join(f"{k}=*" for k in by)

    def keyed(name: str) -> DataFrame:
        rows = spark.read.parquet(f"{path}/{levels}/{name}")
        file = F.col("_metadata.file_path")
        return rows.select("*", *[F.regexp_extract(file, f"/{k}=([^/]+)/", 1).cast(kind).alias(k) for k, kind in by.items()])

    n = F.col("nodeData")
    plain = F.when(n["split"]["numCategories"] >= 0, F.raise_error(F.lit("a split by category"))).otherwise(
        F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)))
    nodes = keyed("data").select(
        *by, F.col("treeID").alias("tree"), n["id"].alias("node"), n["split"]["featureIndex"].alias("feature"),
        plain.cast("double").alias("threshold"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["prediction"].alias("value"), n["rawCount"].alias("samples"), n["gain"].alias("gain"))
    weights = keyed("treesMetadata").select(*by, F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    return nodes.join(weights, [*by, "tree"])


def first_rounds(nodes: DataFrame, rounds: DataFrame, by: Sequence[str]) -> DataFrame:
    """The nodes of each model's first ``round`` trees (``by, round``)."""
    return nodes.join(rounds.select(*by, "round"), list(by)).where("tree < round").drop("round")


def split_counts(nodes: DataFrame, features: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``by, place, feature, splits, share, gain``: how often the trees of a model split by each feature.

    Shares of a model add up to 1; ``place`` 1 has the most splits, equal ones are in order of their names.  Features in no
    split have no row, and a model without a split has none at all.
    """
    names = F.array(*[F.lit(c) for c in features])
    counted = nodes.where("feature >= 0").groupBy(*by, "feature").agg(F.count(F.lit(1)).alias("splits"), F.sum("gain").alias("gain"))
    named = counted.withColumn("feature", F.get(names, "feature"))
    model = Window.partitionBy(*by)  # one row per feature
    return named.select(
        *by, F.row_number().over(model.orderBy(F.desc("splits"), "feature")).alias("place"), "feature", "splits",
        (F.col("splits") / F.sum("splits").over(model)).alias("share"), "gain")


class Forest:
    """The ensemble of one key, all trees one after the other; leaves point to themselves."""

    def __init__(self, nodes: pd.DataFrame):
        nodes = nodes.sort_values(["tree", "node"])
        tree, node = nodes["tree"].to_numpy(np.int64), nodes["node"].to_numpy(np.int64)
        self.roots = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]])
        start = np.repeat(self.roots, np.diff(np.r_[self.roots, len(tree)]))
        if (node != np.arange(len(node)) - start).any():
            raise ValueError("a tree lacks nodes")
        leaf = nodes["feature"].to_numpy(np.int64) < 0
        own = np.arange(len(node))
        self.feature = np.where(leaf, 0, nodes["feature"].to_numpy(np.int64))
        self.threshold = np.where(leaf, 0.0, nodes["threshold"].to_numpy(float))
        self.left = np.where(leaf, own, start + nodes["left"].to_numpy(np.int64))
        self.right = np.where(leaf, own, start + nodes["right"].to_numpy(np.int64))
        self.value = nodes["value"].to_numpy(float)
        self.weight = nodes["weight"].to_numpy(float)[self.roots]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Weighted sum of the trees' values, added in the order of the trees."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for root, weight in zip(self.roots.tolist(), self.weight.tolist(), strict=True):
            at = np.full(len(x), root)
            while True:
                after = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
                if (after == at).all():
                    break
                at = after
            total += weight * self.value[at]
        return total


def _forests(nodes: pd.DataFrame, by: list[str]) -> dict[tuple, Forest]:
    return {key: Forest(own) for key, own in nodes.groupby(by, sort=False)}


def _scores(keys: pd.DataFrame, x: np.ndarray, forests: dict[tuple, Forest]) -> pa.Array:
    out, known = np.full(len(x), np.nan), ~np.isnan(x).any(axis=1)
    for key, at in keys.groupby(list(keys.columns), sort=False).indices.items():
        forest = forests.get(key if isinstance(key, tuple) else (key,))
        at = at[known[at]]
        if forest is not None and len(at):
            out[at] = forest.score(x[at])
    return pa.array(out, mask=np.isnan(out))


def score_trees(rows: DataFrame, nodes: DataFrame, features: Sequence[str], by: Sequence[str], out: str = "prediction",
                log: bool = True, sent_nodes: int = SENT_NODES, part_rows: int = PART_ROWS) -> DataFrame:
    """``rows`` with the prediction of the model of their key ``by``; ``log`` models give the logarithm.

    A row without a model or with an unknown feature has a null prediction.  One scan of ``rows``, however many models
    there are: up to ``sent_nodes`` nodes (counted) all models are sent to the tasks, and rows are not shuffled; beyond, rows
    and models meet by key, the rows of a key in parts of about ``part_rows``.
    """
    by, features = list(by), list(features)
    table = nodes.select(*by, "tree", "node", "feature", "threshold", "left", "right", "value", "weight")
    raw = "_raw_score"
    if table.count() <= sent_nodes:
        forests = _forests(table.toArrow().to_pandas(date_as_object=True), by)
        shared = rows.sparkSession.sparkContext.broadcast(forests)

        @F.arrow_udf(T.DoubleType())
        def sent(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            for batch in batches:
                keys = pa.table(list(batch[:len(by)]), names=by).to_pandas(date_as_object=True)
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch[len(by):]])
                yield _scores(keys, x, shared.value)

        scored = rows.withColumn(raw, sent(*by, *[F.col(f"`{c}`").cast("double") for c in features]))
    else:
        parts = rows.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("_parts"))
        dealt = rows.join(parts, by, "left").withColumn(
            "_part", F.floor(F.rand(seed=7) * F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts")
        copies = table.join(parts, by).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
        schema = T.StructType([*dealt.schema.fields, T.StructField(raw, T.DoubleType())])

        def meet(own: pd.DataFrame, models: pd.DataFrame) -> pd.DataFrame:
            found = _scores(own[by], own[features].to_numpy(float), _forests(models, by) if len(models) else {})
            return own.assign(**{raw: found.to_pandas()})

        scored = dealt.groupBy(*by, "_part").cogroup(copies.groupBy(*by, "_part")).applyInPandas(meet, schema).drop("_part")
    value = F.exp(F.col(raw)) if log else F.col(raw)
    return scored.withColumn(out, value).select(*rows.columns, out)


def route_to_issue(rows: DataFrame, issues: DataFrame, by: Sequence[str], date: str = "date", out: str = "issued") -> DataFrame:
    """``rows`` with the date of the latest model of their key that was ``issued`` on or before ``date``; null before the
    first.  ``issues`` (``by, issued``) has one row per model, so a key's issue dates are a short list."""
    dates = issues.groupBy(*by).agg(F.collect_set("issued").alias("_issues"))
    latest = F.array_max(F.filter("_issues", lambda d: d <= F.col(date)))
    return rows.join(dates, list(by), "left").withColumn(out, latest).select(*rows.columns, out)
