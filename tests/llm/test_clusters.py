import hashlib
import math
import random

import numpy as np

from gridcast.llm import clusters

SCHEMA = "vec_id bigint, embedding array<float>, cluster string, v int, `lead` int, rest string"


def table_of(spark, rows):
    return spark.createDataFrame([(k, v, "x", 1, 2, "r") for k, v in rows], SCHEMA)


def by_hand(rows, count, rounds, dims):
    """The same in plain Python, every distance computed."""
    kept = [(k, [math.floor(64 * c) for c in v]) for k, v in rows
            if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [list(v) for _, v in order[:count]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            group = [v for (_, v), k in zip(kept, own, strict=True) if k == n]
            if group:
                centroids[n] = [sum(c) // len(group) for c in zip(*group, strict=True)]
    found = [nearest(v) for _, v in kept]
    out = []
    for (key, _), (far, n) in zip(kept, found, strict=True):
        digest = hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()
        out.append((key, n, far, sum(d for d, k in found if k == n), sum(d for d, _ in found), digest))
    return sorted(out, key=str)


def check(spark, rows, **options):
    got = clusters.clustered(table_of(spark, rows).repartition(5), **options)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == by_hand(
        rows, options.get("count", 16), options.get("rounds", 3), options.get("dims", 64))


def vectors(n, dims, seed, spread=1.0):
    draw = random.Random(seed)
    centres = [[draw.uniform(-2, 2) for _ in range(dims)] for _ in range(5)]
    return [(k, [float(np.float32(c + draw.gauss(0, spread))) for c in centres[k % 5]]) for k in range(n)]


def test_against_all_distances(spark):
    check(spark, vectors(300, 64, 1))
    check(spark, vectors(200, 7, 2, 0.1), count=9, rounds=5, dims=7, leading=3)
    check(spark, vectors(60, 3, 3), count=4, dims=3, leading=3)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0]), (4, [1.0, nan]), (5, [inf, 0.0]), (6, [None, 1.0]), (None, [0.5, 0.25]),
            (None, [0.5, 0.25]), (7, [0.0, 0.0]), (7, [0.0, 0.0]), (7, [1.0, 0.0]), (2 ** 62 + 1, [-0.01, 3.0]),
            (8, [1.0, 2.0, 3.0]), (9, [1000.0, -1000.0])]
    check(spark, rows, dims=2, count=3)
    check(spark, rows, dims=2, count=50)
    check(spark, rows, dims=2, count=1, rounds=0)
    empty = clusters.clustered(table_of(spark, rows[:6]), dims=2)
    assert empty.collect() == [] and len(empty.columns) == 6
    assert clusters.clustered(table_of(spark, []), dims=2).collect() == []


def test_ties_and_a_third_of_equal_rows(spark):
    rows = [(k, [float(x), float(y)]) for k, (x, y) in enumerate((x, y) for x in range(-3, 4) for y in range(-3, 4))]
    check(spark, rows + [(100 + k, [1.0, 1.0]) for k in range(25)], dims=2, count=6)


def test_large_components_are_held_and_far_means_filter_rightly(spark):
    most = clusters.bound(2)
    found = clusters.clustered(table_of(spark, [(1, [1e30, 0.0]), (2, [-1e30, 0.0])]), dims=2, count=1, rounds=0)
    assert {r.distance for r in found.collect()} == {0, (2 * most) ** 2}
    draw = random.Random(5)
    check(spark, [(k, [2.0 ** 20 + draw.randrange(3), -2.0 ** 20 + draw.randrange(3) / 8]) for k in range(150)], dims=2, count=5, leading=1)


def test_the_bound_skips_distances():
    draw = np.random.default_rng(1)
    centres = draw.integers(-300, 300, (16, 64))
    v = centres[draw.integers(0, 16, 2000)] + draw.integers(-20, 20, (2000, 64))
    moments = np.cov(v.T)
    rotation = clusters.Rotation(v.mean(axis=0), np.linalg.eigh(moments)[1][:, ::-1][:, :16])
    lead, rest = rotation.leading(v.astype(float))
    number, far, computed = clusters.Filter(rotation, centres).nearest(v, lead, rest)
    exact = ((v[:, None] - centres) ** 2).sum(axis=2)
    assert (number == exact.argmin(axis=1)).all() and (far == exact.min(axis=1)).all()
    assert computed < 1.1 * len(v)  # of 16 times as many


def test_no_vector_is_collected(spark):
    found, centroids = clusters.cluster(table_of(spark, vectors(500, 8, 4)), dims=8, count=3)
    assert centroids.shape == (3, 8) and found.count() == 500
    plan = found._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
