"""Centroid clustering with PCA-rotated filtering.

Vectors become integers, and the rounds are exact: nearest centroid by squared distance, then means rounded down.  To
skip most of the distances, every vector is stored once with its leading coordinates after a rotation onto the principal
axes and with the norm of what is left.  Distance in the leading coordinates plus the squared difference of the left-over
norms is at most the true squared distance, so a centroid whose bound lies above the distance to some other one is out;
the survivors are verified in integers.  The rotation changes no result: it only decides how many survive.

A round reads the stored vectors once.  Tasks add up their vectors by centroid, so a round shuffles one row per
centroid, component and task, and the driver gets one row per centroid and component, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.llm.common import checkpointed, shipped

#: Vectors that a task compares at a time, and the bits of a component that are summed apart.
BLOCK, HALF = 4096, 16


def bound(dims: int) -> int:
    """Largest integer component: squared distances of such vectors stay within 63 bits."""
    return isqrt((2 ** 63 - 1) // (4 * max(dims, 1)))


def integer_vectors(rows: DataFrame, dims: int, key: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component, held within ``bound(dims)``; only rows with exactly ``dims``
    components, none null or non-finite."""
    most = float(bound(dims))
    x = F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double"))
    usable = (F.size("x") == dims) & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.select(F.col(f"`{key}`").alias("vec_id"), x.alias("x")).where(F.col("x").isNotNull() & usable).select(
        "vec_id", F.transform(
            "x", lambda c: F.floor(F.least(F.greatest(c * scale, F.lit(-most)), F.lit(most))).cast("int")).alias("v"))


@dataclass
class Rotation:
    """The leading principal axes of the vectors."""

    mean: np.ndarray
    axes: np.ndarray  # (dims, number of leading coordinates)

    def leading(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates, and the norm of the rest."""
        centred = x - self.mean
        lead = centred @ self.axes
        rest = centred - lead @ self.axes.T
        return lead, np.sqrt((rest * rest).sum(axis=1))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ``BLOCK`` rows at most, none empty."""
    for batch in batches:
        for start in range(0, len(batch), BLOCK):
            yield batch.slice(start, BLOCK)


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)


def _rows(values: np.ndarray) -> pa.Array:
    first = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(first), pa.array(values.ravel()))


def fit_rotation(vectors: DataFrame, dims: int, leading: int) -> Rotation:
    """From the second moments of all vectors; tasks add up their own, one row per pair of components reaches the driver."""

    i, j = np.triu_indices(dims + 1)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims + 1))
        for batch in _parts(batches):
            x = _matrix(batch.column("v"), dims).astype(float)
            x = np.c_[np.ones(len(x)), x]
            total += x.T @ x
        yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(len(i)), pa.int32()), "s": total[i, j]})

    added = vectors.select("v").mapInArrow(moments, "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).toArrow()
    total, at = np.zeros((dims + 1, dims + 1)), added["at"].to_numpy()
    total[i[at], j[at]] = total[j[at], i[at]] = added["s"].to_numpy()
    n = max(total[0, 0], 1.0)
    mean = total[0, 1:] / n
    _, axes = np.linalg.eigh(total[1:, 1:] / n - np.outer(mean, mean))
    return Rotation(mean, np.ascontiguousarray(axes[:, ::-1][:, :leading]))


@dataclass
class Filter:
    """The centroids of a round as integers and as the rotation sees them."""

    rotation: Rotation
    centroids: np.ndarray

    def __post_init__(self):
        self.lead, self.rest = self.rotation.leading(self.centroids.astype(float))

    def nearest(self, v: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid (ties: the smaller), its squared distance, and the number of distances that were
        computed in integers."""
        square = (lead * lead).sum(axis=1)[:, None] + (self.lead * self.lead).sum(axis=1) - 2 * lead @ self.lead.T
        low = np.maximum(square, 0) + (rest[:, None] - self.rest) ** 2
        # rounding: relative to the numbers that the sums are made of
        size = (lead * lead).sum(axis=1)[:, None] + (self.lead * self.lead).sum(axis=1) + rest[:, None] ** 2 + self.rest ** 2
        mean = self.rotation.mean
        low -= 1e-9 * (1 + size) + 1e-15 * float(mean @ mean)
        first = np.argmin(low, axis=1)
        best = self._exact(v, np.arange(len(v)), first)
        number = first.copy()
        rows, others = np.nonzero((low <= best[:, None]) & (np.arange(low.shape[1]) != first[:, None]))
        exact = self._exact(v, rows, others)
        # the least (distance, number) of each row
        order = np.lexsort((others, exact, rows))
        rows, others, exact = rows[order], others[order], exact[order]
        head = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else rows
        at, other, far = rows[head], others[head], exact[head]
        better = (far < best[at]) | ((far == best[at]) & (other < number[at]))
        number[at[better]], best[at[better]] = other[better], far[better]
        return number, best, len(v) + len(rows)

    def _exact(self, v: np.ndarray, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        out = np.empty(len(rows), np.int64)
        for start in range(0, len(rows), BLOCK):
            part = slice(start, start + BLOCK)
            apart = v[rows[part]] - self.centroids[others[part]]
            out[part] = (apart * apart).sum(axis=1)
        return out


def _assigned(filtered: Filter, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The integer vectors of stored rows, the number of each one's centroid, and the distance."""
    dims, leading = filtered.rotation.axes.shape
    v = _matrix(batch.column("v"), dims).astype(np.int64)
    lead = _matrix(batch.column("lead"), leading)
    return v, *filtered.nearest(v, lead, batch.column("rest").to_numpy())[:2]


def _renewed(stored: DataFrame, old: np.ndarray, rotation: Rotation) -> np.ndarray:
    """The mean of each centroid's vectors, rounded down; a centroid without vectors stays."""
    shared = shipped(stored.sparkSession, Filter(rotation, old))
    count, dims = old.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # sums in two parts, so that they cannot overflow
        high, low, n = np.zeros((count, dims), np.int64), np.zeros((count, dims), np.int64), np.zeros(count, np.int64)
        for batch in _parts(batches):
            v, number, _ = _assigned(shared.value, batch)
            for k in np.unique(number):
                own = v[number == k]
                high[k] += (own >> HALF).sum(axis=0)
                low[k] += (own & ((1 << HALF) - 1)).sum(axis=0)
            n += np.bincount(number, minlength=count)
        at, dim = np.nonzero(np.broadcast_to(n[:, None] > 0, high.shape))
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(at, pa.int32()), "dim": pa.array(dim, pa.int32()), "n": n[at], "high": high[at, dim], "low": low[at, dim]})

    total = F.sum(F.col("high").cast("decimal(38,0)") * F.lit(1 << HALF)) + F.sum(F.col("low").cast("decimal(38,0)"))
    sums = stored.select("v", "lead", "rest").mapInArrow(add_up, "cluster int, dim int, n bigint, high bigint, low bigint")
    found = sums.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), total.cast("decimal(38,0)").alias("total")).collect()
    new = old.copy()
    for r in found:
        new[r.cluster, r.dim] = int(r.total) // r.n
    return new


def _starts(vectors: DataFrame, count: int, seed: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``<seed>:<vec_id>``: each is an integer row."""
    chosen = vectors.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("h"), "v")
    return np.array([r.v for r in chosen.orderBy(F.asc_nulls_last("h"), "v").limit(count).collect()], np.int64)


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(rows: DataFrame, count: int = 16, rounds: int = 3, dims: int = 64, seed: int = 1, key: str = "vec_id",
            vector: str = "embedding", scale: int = 64, leading: int = 16) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every usable vector, and the final centroids.

    Usable are vectors with exactly ``dims`` components, none null or non-finite; the others are left out.  Integers
    beyond ``bound(dims)`` are held there, so a distance always fits.  The first centroids are the vectors with the smallest
    hashes of their ids, equal ids by vector, null ids last; there are fewer where there are fewer vectors.  Repeated rows
    count and are assigned each; equal centroids: the smaller number takes all.  An empty table gives an empty one and no
    centroid.  Further columns are not read.
    """
    vectors = integer_vectors(rows, dims, key, vector, scale)
    centroids = _starts(vectors, count, seed)
    if not len(centroids):
        return vectors.selectExpr("vec_id", "0 AS cluster", "0L AS distance"), np.zeros((0, dims), np.int64)
    rotation = fit_rotation(vectors, dims, min(leading, dims))

    def rotated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            lead, rest = rotation.leading(_matrix(batch.column("v"), dims).astype(float))
            yield pa.RecordBatch.from_arrays([*batch.columns, _rows(lead), pa.array(rest)], names=[f.name for f in kept.fields])

    kept = T.StructType([*vectors.schema.fields, T.StructField("lead", T.ArrayType(T.DoubleType())), T.StructField("rest", T.DoubleType())])
    stored = checkpointed(vectors.mapInArrow(rotated, kept))
    for _ in range(rounds):
        centroids = _renewed(stored, centroids, rotation)
    shared = shipped(rows.sparkSession, Filter(rotation, centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            _, number, far = _assigned(shared.value, batch)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(number, pa.int32()), pa.array(far, pa.int64())],
                                             names=["vec_id", "cluster", "distance"])

    given = T.StructType([kept["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    return stored.mapInArrow(assign, given), centroids


def clustered(rows: DataFrame, key: str = "vec_id", **options) -> DataFrame:
    """``key``, cluster and distance of every usable vector with ``cluster_inertia`` and ``inertia`` (distance summed over
    its cluster and over all; null where a sum exceeds 63 bits) and the digest of its final centroid; odd rows as in
    ``cluster``."""
    found, centroids = cluster(rows, key=key, **options)
    if not len(centroids):
        return found.selectExpr("vec_id", "cluster", "distance", "0L AS cluster_inertia", "0L AS inertia",
                                "'' AS centroid_sha256").withColumnRenamed("vec_id", key)
    found = checkpointed(found)
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    whole = sum(int(r.s) for r in sums)

    def fits(total: int):
        return total if total < 2 ** 63 else None

    table = rows.sparkSession.createDataFrame(
        [(r.cluster, fits(int(r.s)), fits(whole), digest(centroids[r.cluster])) for r in sums],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # one row per centroid
    return found.join(F.broadcast(table), "cluster").select(
        F.col("vec_id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def cluster_sql(count: int, rounds: int, dims: int) -> str:
    """DuckDB SQL for ``clustered`` on ``embeddings``, as long as components stay within ``bound(dims)``."""
    steps = ["""WITH x AS (SELECT vec_id, list_transform(embedding, lambda c: floor(64 * CAST(c AS DOUBLE))) AS f FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = %d
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
v AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(f, lambda c: CAST(c AS BIGINT)) AS v FROM x),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS k, v AS c FROM v
  ORDER BY k LIMIT %d)""" % (dims, count)]
    for k in range(rounds + 1):
        steps.append(f"""d{k} AS (SELECT id, vec_id, k, v,
  CAST(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM v CROSS JOIN c{k}),
a{k} AS MATERIALIZED (SELECT * FROM d{k} QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, k) = 1)""")
        if k < rounds:
            steps.append(f"""t{k} AS (SELECT k, i, sum(v[i]) AS s, count(*) AS n FROM a{k}, range(1, {dims + 1}) r(i) GROUP BY k, i),
m{k} AS (SELECT k, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM t{k} GROUP BY k),
c{k + 1} AS MATERIALIZED (SELECT k, coalesce(m{k}.c, c{k}.c) AS c FROM c{k} LEFT JOIN m{k} USING (k))""")
    last = rounds
    return ",\n".join(steps) + f"""
SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{last} JOIN c{last} USING (k)"""
