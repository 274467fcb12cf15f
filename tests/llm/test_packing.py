"""Optimal boundaries against all choices, and what batches must keep."""

import itertools
import random
from collections import Counter

from gridcast.llm import packing, queries


def least_padding(lengths, buckets):
    own = sorted(set(lengths))
    return min((sum(next(x for x in cuts if x >= n) - n for n in lengths)
                for r in range(1, buckets + 1) for cuts in itertools.combinations(own, r) if cuts[-1] == own[-1]), default=0)


def test_boundaries_are_optimal():
    rng = random.Random(3)
    for _ in range(200):
        lengths = [rng.choice([1, 2, 3, 5, 8, 13, 40]) for _ in range(rng.randint(0, 12))]
        own = sorted(Counter(lengths).items())
        for k in (1, 2, 3, 9):
            cuts, padding = packing.best_boundaries([n for n, _ in own], [c for _, c in own], k)
            assert len(cuts) <= k and padding == least_padding(lengths, k)
            assert padding == sum(next(x for x in cuts if x >= n) - n for n in lengths)


def test_histogram_has_every_length(spark):
    lengths = list(range(1, 3000)) + [10 ** 6 + 37 * i for i in range(2000)] + [10 ** 9] * 3
    got = packing.histogram(spark.createDataFrame([(n,) for n in lengths], "n_tokens bigint").repartition(5))
    assert list(zip(*got)) == sorted(Counter(lengths).items())


def test_many_distinct_lengths_are_no_other_case():
    """Twice the lengths that were put into bins once; runs of equal gaps have a known optimum."""
    size, runs = 1 << 18, 4
    lengths = [r * 10 ** 7 + i for r in range(1, runs + 1) for i in range(size // runs)]
    cuts, padding = packing.best_boundaries(lengths, [1] * size, runs)
    n = size // runs
    assert cuts == [r * 10 ** 7 + n - 1 for r in range(1, runs + 1)] and padding == runs * n * (n - 1) // 2


def check(rows, n_rows, budget, buckets):
    assert len(rows) == n_rows
    by_batch = {}
    for r in rows:
        by_batch.setdefault(r.batch_id, []).append(r)
    assert sorted(by_batch) == list(range(len(by_batch)))
    last = {}
    for number, batch in by_batch.items():
        assert len({(r.bucket, r.boundary) for r in batch}) == 1
        assert sorted(r.slot for r in batch) == list(range(len(batch)))
        assert all(r.n_tokens <= r.boundary for r in batch)
        assert len(batch) == 1 or len(batch) * batch[0].boundary <= budget
        last.setdefault(batch[0].bucket, []).append((number, len(batch), max(1, budget // batch[0].boundary)))
    assert len(last) <= buckets
    for batches in last.values():  # all but the last batch of a bucket are full
        assert all(size == full for _, size, full in sorted(batches)[:-1])


def test_batches(docs_of):
    rng = random.Random(6)
    rows = [(i, "w " * rng.choice([1, 3, 10, 11, 60, 400])) for i in range(600)]
    rows += [(1, None), (2, ""), (None, "a b"), (None, "a b"), (5, "x"), (5, "x"), (7, "w " * 5000)]
    for parts in (1, 7):
        got = packing.pack(docs_of(rows).repartition(parts), buckets=4, budget=1024).collect()
        check(got, len(rows), 1024, 4)
        want = Counter((k, len((t or "").split()) + 1) for k, t in rows)
        assert Counter((r.doc_id, r.n_tokens) for r in got) == want
        lengths = [r.n_tokens for r in got]
        assert sum(r.boundary - r.n_tokens for r in got) == quadratic(lengths, 4)


def quadratic(lengths, buckets):
    """The least padding by the plain recursion over distinct lengths."""
    own = sorted(Counter(lengths).items())
    cost = [0] + [10 ** 18] * len(own)
    best = 10 ** 18
    for _ in range(min(buckets, len(own))):
        cost = [10 ** 18] + [min(cost[i] + sum((own[j][0] - n) * c for n, c in own[i:j + 1]) for i in range(j + 1))
                             for j in range(len(own))]
        best = min(best, cost[-1])
    return best


def test_long_lengths_are_packed_by_their_exact_values(docs_of):
    rng = random.Random(11)
    skewed = [1000] * 300 + [1001] * 300 + [1002] * 10 + [1003] * 10
    spread = [rng.choice([3, 40, 255, 256, 300, 401, 402, 511, 5001]) for _ in range(200)]
    spread += [rng.randint(257, 900) for _ in range(40)]
    for lengths, buckets in ((skewed, 4), (spread, 5), (spread, 16)):
        got = packing.pack(docs_of([(i, "w " * (n - 1)) for i, n in enumerate(lengths)]), buckets=buckets).collect()
        assert Counter(r.n_tokens for r in got) == Counter(lengths)
        assert sum(r.boundary - r.n_tokens for r in got) == quadratic(lengths, buckets)
    assert quadratic(skewed, 4) == 0


def test_empty_table(docs_of):
    assert packing.pack(docs_of([(1, "a")]).where("false")).collect() == []


def test_whole_table(spark, small):
    got = queries.QUERIES["op4_packing"](spark, small).collect()
    check(got, spark.read.parquet(f"{small}/documents.parquet").count(), 32768, 16)
    assert sum(r.boundary - r.n_tokens for r in got) == quadratic([r.n_tokens for r in got], 16)
