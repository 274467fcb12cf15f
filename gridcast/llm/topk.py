"""Exact top-k by inner product with a pivot-distance index.

Vectors become integers.  With M the largest norm, x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) have the squared
distance |q|^2 + M^2 - 2 q.x, so the largest inner products are the nearest neighbours, and the triangle inequality
holds.  Every vector is keyed by its nearest pivot and its distance to it; a pivot's vectors fall into annuli sorted by
distance, and an annulus into blocks by hash, so a block is small however many equal vectors there are.

A query first searches one block around itself.  Its k-th score there bounds how far the rest can lie; the search
expands to the annuli, pivot by pivot, whose distances the triangle inequality does not rule out, and stops there.
A block gives only what reaches that k-th score.
Query and block meet by key (pivot, annulus, block), the queries of a block in parts, so a task holds one block and
one part.  Bounds have a margin for rounding; scores are exact integers.

Pivots are fitted on a bounded sample; all rows are indexed, and any pivots give the same result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.common import checkpointed

#: Vectors of the sample that pivots are fitted on, pivots, and annuli of a pivot, at most.  Beyond, annuli hold more
#: blocks.  The table of annulus bounds is sent to all tasks: PIVOTS rows of RINGS numbers.
SAMPLE, PIVOTS, RINGS = 4096, 256, 1024
FOUND = "query_id bigint, vec_id bigint, score bigint"


def integer_vectors(rows: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component; rows with a null id, a null vector, or a null or non-finite
    component are left out."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    usable = F.col(key).isNotNull() & F.col(vector).isNotNull() & F.forall(
        F.col("x"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.select(F.col(key).alias(key), F.col(vector).alias(vector), x.alias("x")).where(usable).select(
        F.col(key).alias("vec_id"), F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


@dataclass
class Space:
    """The augmented space and its pivots."""

    dims: int
    norm2: float
    pivots: np.ndarray  # (number, dims + 1)

    def matrix(self, vectors) -> np.ndarray:
        """Integer vectors as rows; a shorter one is filled with zeros."""
        out = np.zeros((len(vectors), self.dims))
        for row, v in zip(out, vectors, strict=True):
            row[:len(v)] = v
        return out

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, self.norm2 - (x * x).sum(axis=1)))
        return np.c_[x, last]

    def distances(self, points: np.ndarray) -> np.ndarray:
        square = (points * points).sum(axis=1)[:, None] + (self.pivots * self.pivots).sum(axis=1) - 2 * points @ self.pivots.T
        return np.sqrt(np.maximum(0, square))

    @property
    def margin(self) -> float:
        return 1e-5 * (1 + float(np.sqrt(self.norm2)))


def fit_pivots(points: np.ndarray, count: int, rounds: int = 4) -> np.ndarray:
    """Farthest points first, then a few rounds of means; the same for the same points."""
    chosen = [0]
    near = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(points)):
        chosen.append(int(np.argmax(near)))
        near = np.minimum(near, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    pivots = points[chosen].copy()
    for _ in range(rounds):
        square = (pivots * pivots).sum(axis=1) - 2 * points @ pivots.T
        own = np.argmin(square, axis=1)
        for k in range(len(pivots)):
            if (own == k).any():
                pivots[k] = points[own == k].mean(axis=0)
    return pivots


def best_in_block(
    queries: np.ndarray, query_ids: np.ndarray, least: np.ndarray, block: np.ndarray, ids: np.ndarray, k: int,
) -> pd.DataFrame:
    """Each query's k best of a block by (score, smaller id), the query's own id left out, and nothing under ``least``:
    the query's k-th score elsewhere (NaN: not known)."""
    if not len(queries) or not len(block):
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
    exact = np.abs(queries).max(initial=0) * np.abs(block).max(initial=0) * queries.shape[1] < 2 ** 53
    scores = (queries @ block.T if exact else queries.astype(np.int64) @ block.astype(np.int64).T).astype(np.int64)
    allowed = query_ids[:, None] != ids[None, :]
    low = np.iinfo(np.int64).min
    shown = np.where(allowed, scores, low)
    place = min(k, shown.shape[1]) - 1
    cut = -np.partition(-np.maximum(shown, low + 1), place, axis=1)[:, place]
    # a score beyond 2^53 may have been rounded up on its way
    floor = np.where(np.abs(least) < 2 ** 53, least, np.nextafter(least, -np.inf))
    cut = np.where(np.isnan(least), cut, np.maximum(cut, np.nan_to_num(floor).astype(np.int64)))
    row, column = np.nonzero(allowed & (shown >= cut[:, None]))
    order = np.lexsort((ids[column], -scores[row, column], row))
    row, column = row[order], column[order]
    first = np.searchsorted(row, np.arange(len(queries)))
    keep = np.arange(len(row)) - first[row] < k
    row, column = row[keep], column[keep]
    return pd.DataFrame({"query_id": query_ids[row], "vec_id": ids[column], "score": scores[row, column]})


def _search(space: Space, k: int):
    def run(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        return best_in_block(space.matrix(queries["v"]), queries["query_id"].to_numpy(np.int64),
                             queries["least"].to_numpy(float), space.matrix(block["v"]), block["vec_id"].to_numpy(np.int64), k)

    return run


BLOCK = ["pivot", "annulus", "chunk"]


def _searched(pairs: DataFrame, queries: DataFrame, index: DataFrame, space: Space, k: int, part_size: int) -> DataFrame:
    """k best of each (query, block) of ``pairs``: the queries of a block in parts of about ``part_size``."""
    parts = pairs.groupBy(*BLOCK).agg(F.ceil(F.count(F.lit(1)) / part_size).cast("int").alias("parts"))
    cell = [*BLOCK, "part"]
    left = (pairs.join(parts, BLOCK).withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int"))
            .join(queries, "query_id").select(*[F.col(c).alias(c) for c in (*cell, "query_id", "v", "least")]))
    right = index.join(parts, BLOCK).select(
        *BLOCK, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "vec_id", "v")
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(_search(space, k), FOUND)


def top_k(rows: DataFrame, every: int, k: int = 20, key: str = "vec_id", vector: str = "embedding", scale: int = 64,
          block_size: int = 2048, part_size: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of each row whose id is divisible by ``every``.

    Candidates are all rows with another id, fewer than ``k`` where there are fewer; ties go to the smaller id.
    Rows with a null id or an unusable vector take no part; shorter vectors are filled with zeros.  A repeated row is a
    candidate as often as it comes; rows of one id make one query, by the smallest vector.  An empty table gives an
    empty one.  Scores must fit 63 bits.  Further columns are not read.
    """
    spark = rows.sparkSession
    vectors = integer_vectors(rows, key, vector, scale)
    norm2 = F.aggregate(F.transform("v", lambda c: c.cast("double")), F.lit(0.0), lambda a, c: a + c * c)
    n, dims, largest = vectors.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(norm2)).first()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    space = Space(dims, largest, np.zeros((1, dims + 1)))
    pivots = int(min(PIVOTS, max(1, np.ceil(np.sqrt(n / block_size)))))
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow().to_pandas()
    space = Space(dims, largest, fit_pivots(space.lifted(space.matrix(sample["v"]), False), pivots))

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            far = space.distances(space.lifted(space.matrix(batch["v"]), False)) if len(batch) else np.zeros((0, 1))
            own = np.argmin(far, axis=1)
            yield batch.assign(pivot=own.astype("int32"), far=far[np.arange(len(batch)), own])

    # a number of the row, kept with it: rows of one id and one vector are dealt over chunks like any others
    placed = checkpointed(vectors.mapInPandas(keyed, "vec_id bigint, v array<bigint>, pivot int, far double")
                          .withColumn("row", F.monotonically_increasing_id()))
    rings = int(min(RINGS, np.ceil(n / (pivots * block_size))))
    cuts = placed.groupBy("pivot").agg(
        F.percentile_approx("far", [(r + 1) / rings for r in range(rings)]).alias("cuts"))
    ring = F.size(F.filter("cuts", lambda c: c < F.col("far")))
    ringed = placed.join(F.broadcast(cuts), "pivot").withColumn("annulus", F.least(ring, F.lit(rings - 1))).drop("cuts")
    rounds = ringed.groupBy("pivot", "annulus").agg(
        F.min("far").alias("near"), F.max("far").alias("most"), F.ceil(F.count(F.lit(1)) / block_size).cast("int").alias("chunks"))
    rounds = checkpointed(rounds)
    index = checkpointed(
        ringed.join(rounds.select("pivot", "annulus", "chunks"), ["pivot", "annulus"])
        .withColumn("chunk", F.pmod(F.xxhash64("vec_id", "row"), F.col("chunks")).cast("int"))
        .select("vec_id", "v", *BLOCK))

    asked = index.where(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), F.struct("v", *BLOCK).alias("own"))
    queries = checkpointed(asked.groupBy("query_id").agg(F.min("own").alias("own")).select("query_id", "own.*"))
    unbounded = queries.select("query_id", "v", F.lit(None).cast("double").alias("least"))
    first = checkpointed(_searched(queries.select("query_id", *BLOCK), unbounded, index, space, k, part_size))
    known = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
    bounded = checkpointed(queries.select("query_id", "v").join(
        known.select("query_id", F.col("least").cast("double").alias("least")), "query_id", "left"))

    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = space.matrix(batch["v"])
            far = space.distances(space.lifted(x, True)) if len(x) else np.zeros((0, len(space.pivots)))
            least = batch["least"].to_numpy(float)
            square = (x * x).sum(axis=1) + space.norm2 - 2 * least
            radius = np.where(np.isnan(least), np.inf, np.sqrt(np.maximum(0, square))) + space.margin
            which = np.tile(np.arange(far.shape[1], dtype="int32"), len(batch))
            yield pd.DataFrame({"query_id": np.repeat(batch["query_id"].to_numpy(np.int64), far.shape[1]), "pivot": which,
                                "low": (far - radius[:, None]).ravel(), "high": (far + radius[:, None]).ravel()})

    spans = bounded.mapInPandas(reach, "query_id bigint, pivot int, low double, high double")
    open_rings = rounds.select("pivot", "annulus", "near", "most", "chunks")
    pairs = (
        spans.join(open_rings, "pivot").where("near <= high AND most >= low")
        .select("query_id", "pivot", "annulus", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
        .join(queries.select("query_id", *BLOCK).withColumn("done", F.lit(True)), ["query_id", *BLOCK], "left_anti")
    )
    rest = _searched(pairs, bounded, index, space, k, part_size)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return first.union(rest).withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
