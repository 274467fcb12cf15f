"""Exact top-k against all products; the index rules blocks out without losing any."""

import numpy as np
import pytest

from gridcast.llm import topk


def by_hand(rows, every, k, scale=64):
    ok = [(i, np.floor(scale * np.array(v, float)).astype(int)) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    size = max((len(v) for _, v in ok), default=0)
    ok = [(i, np.r_[v, np.zeros(size - len(v), int)].astype(int)) for i, v in ok]
    out = set()
    for q, v in ok:
        if q % every == 0:
            best = sorted((-int(v @ w), c) for c, w in ok if c != q)[:k]
            out |= {(q, n, c, -s) for n, (s, c) in enumerate(best, 1)}
    return out


def frame(spark, rows):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr(
        "*", "1 AS label", "2 AS score", "3 AS v", "4 AS pivot", "5 AS x")


def clusters(n, dims, seed, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    x = centres[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, dims))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


@pytest.mark.parametrize("spread, block", [(0.05, 16), (1.0, 16), (0.05, 4096)])
def test_equals_brute_force(spark, spread, block):
    rows = [(i, v.tolist()) for i, v in enumerate(clusters(700, 16, 3, spread))]
    got = topk.top_k(frame(spark, rows), 20, 20, block_size=block, part_size=8)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert {tuple(r) for r in got.collect()} == by_hand(rows, 20, 20)


def test_ties_and_a_very_common_vector(spark):
    rows = [(i, [1.0, 0.5]) for i in range(300)] + [(300 + i, [0.5, 1.0 + i / 64]) for i in range(40)]
    got = topk.top_k(frame(spark, rows), 20, 5, block_size=16, part_size=4)
    assert {tuple(r) for r in got.collect()} == by_hand(rows, 20, 5)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (20, [-1.0, 3.0]), (40, None), (60, [1.0, None]), (80, [float("nan"), 1.0]), (100, [float("inf"), 1.0]),
            (None, [9.0, 9.0]), (7, [5.0]), (8, []), (-20, [0.0, 0.0]), (9, [1e4, -1e4])]
    got = topk.top_k(frame(spark, rows), 20, 20).collect()
    assert {tuple(r) for r in got} == by_hand(rows, 20, 20) and len(got) == 3 * 5


@pytest.mark.parametrize("rows", [[(1, None)], [(20, [1.0])], [(1, [1.0]), (2, [2.0])]])
def test_nothing_to_find(spark, rows):
    assert topk.top_k(frame(spark, rows), 20, 20).collect() == []
    assert topk.top_k(frame(spark, rows).where("false"), 20, 20).collect() == []


def test_repeated_rows_are_candidates_each(spark):
    rows = [(20, [1.0, 1.0])] * 2 + [(3, [1.0, 1.0])] * 2 + [(4, [0.5, 0.5])]
    got = sorted(tuple(r) for r in topk.top_k(frame(spark, rows), 20, 20).collect())
    assert got == [(20, 1, 3, 8192), (20, 2, 3, 8192), (20, 3, 4, 4096)]


def test_bounds_rule_blocks_out():
    """On clustered vectors the annuli that a query must open are a small share."""
    x = np.floor(64 * clusters(4000, 16, 5, 0.02)).astype(float)
    norm2 = (x * x).sum(axis=1).max()
    space = topk.Space(16, norm2, np.zeros((1, 17)))
    space = topk.Space(16, norm2, topk.fit_pivots(space.lifted(x, False), 12))
    far = space.distances(space.lifted(x, False))
    own, q = np.argmin(far, axis=1), x[:50]
    kth = np.sort(q @ x.T, axis=1)[:, -21]
    radius = np.sqrt(np.maximum(0, (q * q).sum(axis=1) + norm2 - 2 * kth)) + space.margin
    reach = space.distances(space.lifted(q, True))
    opened = np.abs(reach[:, own] - far[np.arange(len(x)), own]) <= radius[:, None]
    best = np.argsort(-(q @ x.T), axis=1, kind="stable")[:, :20]
    assert all(opened[i, best[i]].all() for i in range(50)) and opened.mean() < 0.3


def test_rows_of_one_id_are_dealt_over_chunks(spark, monkeypatch):
    """One id with one vector holds most rows: its rows are spread over the blocks of the index."""
    sizes = []
    searched = topk._searched

    def watched(pairs, queries, index, *rest):
        sizes.append([r["count"] for r in index.groupBy(*topk.BLOCK).count().collect()])
        return searched(pairs, queries, index, *rest)

    monkeypatch.setattr(topk, "_searched", watched)
    rows = [(21, [1.0, 1.0])] * 2000 + [(20 * k, [1.0, k / 64]) for k in range(20)]
    got = topk.top_k(frame(spark, rows).repartition(5), 20, 3, block_size=100, part_size=8).collect()
    assert max(sizes[0]) < 400
    assert {tuple(r) for r in got} == by_hand(rows, 20, 3)
