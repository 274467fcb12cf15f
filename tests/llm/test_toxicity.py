"""Segments against brute force, extreme-value statistics, held-out accuracy."""

import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from gridcast.llm import queries, toxicity


def by_hand(x):
    """The best segment (leftmost and shortest of equal ones), then the same on both sides of it."""
    best = None
    for a in range(len(x)):
        for b in range(a + 1, len(x) + 1):
            total = sum(x[a:b])
            if total > 0 and (best is None or total > best[2] + 1e-9):
                best = (a, b, total)
    if best is None:
        return []
    a, b, _ = best
    return by_hand(x[:a]) + [(a, b)] + [(b + i, b + j) for i, j in by_hand(x[b:])]


def test_segments():
    rng = random.Random(1)
    for _ in range(300):
        x = [rng.randint(-9, 9) + rng.random() for _ in range(rng.randint(0, 14))]
        assert [(a, b) for a, b, _ in toxicity.segments(np.array(x))] == by_hand(x)


def test_segments_of_one_sign():
    assert toxicity.segments(np.array([-1.0, -2.0])) == []
    assert toxicity.segments(np.array([1.0, 2.0])) == [(0, 2, 3.0)]
    assert toxicity.segments(np.zeros(4)) == []


def halves(x, at=0):
    """Segments of a long sequence: the best one by one pass, then the same on both sides of it."""
    todo, found = [(0, len(x))], []
    while todo:
        low, high = todo.pop()
        best, total, start = (0.0, low, low), 0.0, low
        for i in range(low, high):
            if total <= 0:
                total, start = 0.0, i
            total += x[i]
            if total > best[0]:
                best = (total, start, i + 1)
        if best[0] > 0:
            found.append((best[1], best[2]))
            todo += [(low, best[1]), (best[2], high)]
    return sorted(found)


def test_longer_segments():
    rng = random.Random(2)
    for n in (300, 700, 1500):
        for tilt in (0.0, -0.3, 0.2):
            x = [rng.gauss(tilt, 1) for _ in range(n)]
            assert [(a, b) for a, b, _ in toxicity.segments(np.array(x))] == halves(x)


def test_segments_take_linear_time():
    for pair in ([1.0, -2.0], [1.0, -1.0], [2.0, -1.0], [1.0, -1.0 - 1e-9]):
        x = np.array(pair * 100_000)
        began = time.perf_counter()
        toxicity.segments(x)
        assert time.perf_counter() - began < 2


def test_buckets_are_those_of_the_hash():
    known = toxicity.Buckets(1 << 20)
    tokens, first = known.of(pa.array(["Ab, c!  ab", None, "", "--", "é9 C"]))
    by_hand = [xxhash.xxh64(w.encode(), seed=42).intdigest() % (1 << 20) for w in ("ab", "c", "ab", "é9", "c")]
    assert tokens.tolist() == by_hand and first.tolist() == [0, 3, 3, 3, 3, 5]


def test_decay_rate_solves_its_equation():
    scores, share = np.array([-1.0, 2.0]), np.array([0.9, 0.1])
    rate = toxicity.decay_rate(scores, share)
    assert rate > 0 and abs((share * np.exp(rate * scores)).sum() - 1) < 1e-9
    assert toxicity.decay_rate(np.array([-1.0]), np.array([1.0])) == 1.0
    assert toxicity.decay_rate(np.array([5.0]), np.array([1.0])) == 1.0


def test_log_odds_are_cautious():
    odds = toxicity.log_odds(np.array([100.0, 1, 0, 5]), np.array([0.0, 0, 100, 50]), 0.5, 1.0)
    assert odds[0] > odds[1] and odds[0] > 0 > odds[2]


def corpus(spark, n=400):
    rng = random.Random(4)
    plain = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(30, 120))]
        if i % 5 == 0:
            at = rng.randint(0, len(words))
            words[at:at] = [rng.choice(["nasty", "vile", "awful"]) for _ in range(5)]
        rows.append((i, " ".join(words), int(i % 5 == 0), i % 2))
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, toxic int, half int")


def test_finds_the_passage(spark):
    rows, labelled = corpus(spark)
    model = toxicity.learn(labelled, buckets=1 << 14)
    found = {r.doc_id: r.t for r in toxicity.scored(labelled, model, into="t").select("doc_id", "t").collect()}
    assert all((found[i].score >= 0.5) == bool(y) for i, _, y, _ in rows)
    for i, text, y, _ in rows:
        if y:
            words = text.split()
            spans = [words[p.first:p.end] for p in found[i].passages]
            assert any(len(set(s) & {"nasty", "vile", "awful"}) and set(s) <= {"nasty", "vile", "awful"} for s in spans)


def test_repeated_toxic_words_count_each_time(spark, docs_of):
    """A passage after scattered mentions of its words, a passage that comes twice, and one word many times."""
    _, labelled = corpus(spark)
    model = toxicity.learn(labelled, buckets=1 << 14)
    rng = random.Random(9)
    plain = lambda n: [f"w{rng.randrange(200)}" for _ in range(n)]
    passage = "nasty vile awful vile nasty".split()
    texts = {
        1: plain(3000) + ["nasty"] + plain(3000) + ["vile"] + plain(3000) + ["awful"] + plain(3000) + passage + plain(9),
        2: plain(40) + passage + plain(400) + passage + plain(40),
        3: plain(40) + ["nasty"] * 6 + plain(40),
    }
    docs = docs_of([(k, " ".join(words)) for k, words in texts.items()])
    found = {r.doc_id: r[0] for r in toxicity.scored(docs, model).collect()}
    spans = {k: {(p.first, p.end) for p in found[k].passages} for k in texts}
    assert all(found[k].score >= 0.5 for k in texts)
    assert (12003, 12008) in spans[1]
    assert spans[2] == {(40, 45), (445, 450)}
    assert spans[3] == {(40, 46)}


def test_calibration_bears_repeats(spark):
    """Clean documents with one line over and over: at most ``alpha`` of those not learned from are significant."""
    rows, _ = corpus(spark)
    rng = random.Random(2)
    rows += [(1000 + i, "w1 w2 nasty w3 " * rng.choice([1, 1, 2, 8]) if i % 9 == 0 else f"w{i % 200} w5 w6", 0, i % 2) for i in range(200)]
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int, half int")
    model = toxicity.learn(labelled, buckets=1 << 14)
    clean = toxicity.scored(labelled.where("toxic = 0"), model)
    assert clean.where(F.size(f"{clean.columns[0]}.passages") > 0).count() <= 0.06 * clean.count()


def test_fitted_rate():
    rng = np.random.default_rng(3)
    n = rng.integers(50, 500, 20_000)
    best = np.maximum(rng.gumbel(np.log(0.3 * n) / 1.7, 1 / 1.7), 0)  # rate 1.7, K 0.3
    assert abs(toxicity.fitted_rate(best, np.ones(len(n)), n.astype(float), 50.0) - 1.7) < 0.05
    assert toxicity.fitted_rate(best, np.ones(len(n)), n.astype(float), 1.2) == 1.2
    assert toxicity.fitted_rate(np.array([2.0]), np.array([9.0]), np.array([90.0]), 1.5) == 1.5


def test_odd_rows(spark, docs_of):
    _, labelled = corpus(spark)
    model = toxicity.learn(labelled, buckets=1 << 14)
    docs = docs_of([(1, None), (2, ""), (3, " .,"), (None, "nasty vile awful vile"), (5, "w1"), (5, "w1"),
                    (6, "w1 w2 w3 " * 300_000 + "nasty vile awful nasty vile awful nasty")])
    found = toxicity.scored(docs, model)
    assert found.columns == ["__toxicity_", *docs.columns]
    got = [(r.doc_id, r[0].score >= 0.5, r[0].n_tokens) for r in found.collect()]
    assert sorted(got, key=str) == sorted(
        [(1, False, 0), (2, False, 0), (3, False, 0), (None, True, 4), (5, False, 1), (5, False, 1), (6, True, 900_007)], key=str)
    assert toxicity.scored(docs.where("false"), model).collect() == []


@pytest.mark.parametrize("condition", ["false", "toxic = 0", "toxic = 1"])
def test_one_class_or_none(spark, docs_of, condition):
    _, labelled = corpus(spark, 40)
    model = toxicity.learn(labelled.where(condition), buckets=1 << 10)
    scores = [r[0].score for r in toxicity.scored(docs_of([(1, "nasty w1"), (2, None)]), model).collect()]
    assert all(s < 0.5 for s in scores)


def test_held_out_accuracy(spark):
    """On documents with labels that were not learned from (the smallest table with enough of them)."""
    folder = "/root/testdata/sf0.01"
    got = queries.QUERIES["op3_toxicity"](spark, folder)
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    right, n = got.where("held_out").join(labels, "doc_id").agg(
        F.avg((F.col("toxic") == F.col("predicted")).cast("int")), F.count("*")).first()
    assert n > 50 and right > 0.9


def test_whole_query_by_hand(spark, small):
    """Counts, log-odds, segments and scores of every document in plain Python."""
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    model = queries.toxicity_model(docs, labels)
    tokens = {r.doc_id: [xxhash.xxh64(w.encode(), seed=42).intdigest() % len(model.scores)
                         for w in re.split("[^0-9a-z\x80-\U0010ffff]+", (r.text or "").lower()) if w] for r in docs.collect()}
    known = {r.doc_id: r.toxic for r in labels.where("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0").collect()}
    counts = {0: Counter(), 1: Counter()}
    for key, toxic in known.items():
        if key in tokens:
            counts[toxic].update(set(tokens[key]))
    size, (n0, n1) = len(model.scores), (sum(c.values()) for c in (counts[0], counts[1]))

    def odds(bucket):
        t, c = counts[1][bucket] + 0.5, counts[0][bucket] + 0.5
        whole = np.log(t / (n1 + size / 2 - t)) - np.log(c / (n0 + size / 2 - c))
        return float(np.float32(whole - np.sqrt(1 / t + 1 / c)))

    scores = {b: odds(b) for b in {b for t in tokens.values() for b in t}}
    assert all(abs(scores[b] - model.scores[b]) < 1e-4 for b in scores)
    for r in queries.QUERIES["op3_toxicity"](spark, small).collect():
        own = [float(model.scores[b]) for b in tokens[r.doc_id]]
        n, found = len(own), halves(own)
        each = [(a, b, model.tail.rate * sum(own[a:b]) - np.log(model.tail.k * n)) for a, b in found]
        hot = [(a, b) for a, b, e in each if e > -np.log(0.05)]
        evidence = sum(e for a, b, e in each if (a, b) in hot) if hot else max((e for _, _, e in each), default=-np.log(model.tail.k * max(n, 1)))
        score = 1 / (1 + np.exp(-np.clip(model.slope * (evidence - model.centre), -50, 50))) if n else 0.0
        assert abs(r.score - score) < 1e-6 and r.predicted == int(score >= 0.5)
        assert [(p.first, p.end) for p in r.passages] == hot
