"""Text statistics against brute force; decision lists."""

import random
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from gridcast.llm import quality, queries
from gridcast.llm.common import labelled_sample


def by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count, covered, seen, again = Counter(grams), set(), set(), 0
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


TEXTS = [None, "", " \n\t", "a", "a b c a b c", "a a a a", "\n\n x\n x y \x1c z\x85q", "x\nx\nx ", "# * $ % & | < >", "é\U0001d518 b\rc\x0bd"]


def test_statistics():
    rng = random.Random(3)
    for text in TEXTS + ["".join(rng.choice("ab  \n#") for _ in range(rng.randint(0, 80))) for _ in range(400)]:
        assert quality.statistics(text)[:5] == by_hand(text), text


def sample(n=600):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({c: rng.integers(1, 1000, n) for c in quality.COUNTS})
    frame["quality"] = 1 - (((frame.n_symbols >= 800) & (frame.n_words < 500)) | (frame.n_digits < 60)).astype(int)
    return frame


def test_learns_ordered_rules():
    frame = sample()
    rules = quality.learn(frame, "quality")
    assert rules.target == 0 and rules.default == 1 and 1 <= len(rules.rules) <= 24
    assert all(r.right / r.covered > 0.75 for r in rules.rules)
    assert str(rules) == str(quality.learn(frame, "quality"))  # a run repeats


def test_rules_become_one_expression(spark):
    frame = sample()
    rules = quality.learn(frame, "quality")
    df = spark.createDataFrame(frame).select("quality", F.struct(*[F.col(c).cast("long").alias(c) for c in quality.COUNTS]).alias("__stats"))
    judged = df.select("quality", rules.column().alias("says"))
    assert judged.where("quality = says").count() > 0.93 * len(frame)
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CASE WHEN" in plan


def test_nothing_to_learn():
    frame = sample()
    assert quality.learn(frame[:0], "quality").rules == []
    only = quality.learn(frame[frame.quality == 1], "quality")
    assert only.rules == [] and only.default == 1


def test_odd_rows(docs_of):
    good = " ".join(f"word{i}" for i in range(60))
    docs = docs_of([(1, None), (2, ""), (3, good), (3, good), (None, good), (4, "a b c " * 100_000), (5, " ".join(f"w{i}" for i in range(49)))])
    rules = quality.DecisionList([quality.Rule([("n_symbols", True, 5.0)], 0, 0)], 0, 1)
    found = quality.judged(docs, rules)
    assert found.columns == ["__quality_", *docs.columns]
    got = {(r.doc_id, r[0].base_failed, r[0].kept) for r in found.collect()}
    assert got == {(1, True, False), (2, True, False), (3, False, True), (None, False, True), (4, True, False), (5, True, False)}
    assert found.count() == 7
    assert quality.judged(docs.where("false"), rules).collect() == []


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = queries.QUERIES["op7_quality_rules"](spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        n, chars, symbols, lines, repeats = by_hand(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeats)
        assert r.base_failed == (n < 50 or 100 * repeats > 50 * n) and not (r.base_failed and r.kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    judged = [(r.kept, labels[r.doc_id]) for r in got if r.doc_id in labels and not r.base_failed]
    assert sum(k == bool(q) for k, q in judged) > 0.95 * len(judged)
    assert all(k for k, q in judged if q == 1)


def counted(text):
    """All counts of a text, by patterns and counters."""
    words, chars, symbols, again, repeats = by_hand(text)
    own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return dict(n_words=words, word_chars=chars, n_symbols=symbols, n_dup_lines=again, n_repeat_words=repeats, n_lines=len(lines),
                n_upper=len(re.findall("[A-Z]", text or "")), n_digits=len(re.findall("[0-9]", text or "")),
                n_long_words=sum(len(w.encode()) > 20 for w in own), n_distinct_words=len(set(own)))


def test_verdicts_are_those_of_the_list(spark):
    """The learned list, read from its own text, decides every document again on the counts by hand."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rules = quality.learned_rules(labelled_sample(docs, labels, "quality", queries.RULE_ROWS))
    assert rules.rules
    texts = {r.doc_id: r.text for r in docs.collect()}

    def value(counts, name):
        if name in counts:
            return float(counts[name])
        part, whole = quality.SHARES[name]
        return counts[part] / counts[whole] if counts[whole] else 0.0

    def verdict(counts):
        for rule in rules.rules:
            if all((value(counts, n) >= cut) == above for n, above, cut in rule.conditions):
                return rules.target
        return rules.default

    for r in queries.QUERIES["op7_quality_rules"](spark, folder).collect():
        counts = counted(texts[r.doc_id])
        failed = counts["n_words"] < 50 or 100 * counts["n_repeat_words"] > 50 * counts["n_words"]
        assert r.kept == (not failed and verdict(counts) == 1), r.doc_id


def test_one_row_of_each_labelled_key(spark, docs_of):
    """A key that holds most rows is one labelled document: the sample's bound is on rows."""
    rows = [(1, f"text {i % 50}") for i in range(500)] + [(2, "two"), (2, None), (3, None), (4, "four"), (None, "none")]
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 1), (None, 1), (5, 1)], "doc_id bigint, quality int")
    docs = docs_of(rows).repartition(5)
    got = labelled_sample(docs, labels, "quality", 100)
    assert got.columns == ["doc_id", "text", "quality"]
    least = docs.where("doc_id = 1").orderBy(F.xxhash64("text")).first().text
    assert sorted(map(tuple, got.collect()), key=str) == [(1, least, 1), (2, "two", 0), (3, None, 1)]
    for bound in (1, 2, 3):
        assert labelled_sample(docs, labels.where("doc_id < 4"), "quality", bound).count() <= 2 * bound
