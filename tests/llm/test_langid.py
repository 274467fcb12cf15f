"""Rank-order profiles: n-grams, distances, accuracy on rows that were not learned from."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridcast.llm import langid, queries


def by_hand(text):
    counts = Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        padded = f" {word} "
        counts.update(padded[i:i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1))
    del counts[" "]

    def code(gram):
        value = 0
        for char in gram:
            value = value << 21 | ord(char)
        return value

    return {code(g): n for g, n in counts.items()}


TEXTS = ["Hé, the  cat sat—on the 3 mats. " * 40 + "Ünd so", "a", "x y", "...a...", "日本語 テキスト\U0001d518\U0001d52b", "ß1ß"]


@pytest.mark.parametrize("chunk", [2, 3, 7, 100, 1 << 20])
def test_ngrams(chunk):
    rng = random.Random(2)
    for text in [*TEXTS, *("".join(rng.choice("ab é.") for _ in range(rng.randint(1, 60))) for _ in range(200))]:
        codes, n = langid.count_ngrams(text, chunk)
        assert dict(zip(codes.tolist(), n.tolist(), strict=True)) == by_hand(text)


@pytest.mark.parametrize("text", [None, "", "  ", "12 34!", "\n—"])
def test_no_letter(text):
    profiles = langid.Profiles({"en": langid.ranked(langid.count_ngrams("the cat"), 10)}, 10)
    assert profiles.predict(text) == ("und", 0.0)


def test_distance_by_hand():
    a = langid.ranked(langid.count_ngrams("aab"), 4)
    b = langid.ranked(langid.count_ngrams("abb"), 4)
    places = {g: i for i, g in enumerate(b.tolist())}
    want = sum(min(4, abs(places[g] - i)) if g in places else 4 for i, g in enumerate(a.tolist()))
    assert langid.Profiles({"x": b}, 4).distances(a) == [want / 16]
    assert langid.Profiles({"x": a, "y": a}, 4).predict("aab") == ("x", 1.0)  # ties: first by name
    assert langid.Profiles({}, 4).predict("aab") == ("und", 0.0)


def test_learned_profiles_count_every_row(docs_of):
    rows = [(1, "aa ab", "x"), (2, "ab", "x"), (3, "ba", "y"), (4, None, "x"), (5, "zz", None), (6, "", "y"), (6, "ba", "y")]
    profiles = langid.learn(docs_of(rows), size=5)
    assert profiles.languages == ["x", "y"]
    counts = langid.added([langid.count_ngrams(t) for t in ("aa ab", "ab")])
    assert sorted(profiles.codes[0].tolist()) == sorted(langid.ranked(counts, 5).tolist())


def test_odd_rows(docs_of):
    docs = docs_of([(1, "the cat and the hat", "en"), (2, "der hund und die katze", "de"), (3, None), (4, ""), (5, "12"),
                    (None, "the cat"), (1, "the cat and the hat"), (6, "und die " * 400_000, None)])
    found = langid.identify(docs, langid.learn(docs))
    assert found.columns == ["__language_", *docs.columns]
    got = sorted(((r.doc_id or 0), r[0].lang_pred) for r in found.collect())
    assert got == [(0, "en"), (1, "en"), (1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "de")]
    empty = docs.where("false")
    assert langid.identify(empty, langid.learn(empty)).collect() == []


def test_too_many_languages(docs_of):
    with pytest.raises(ValueError, match="languages"):
        langid.learn(docs_of([(i, "word", f"l{i}") for i in range(5)]), size=2, max_languages=3)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.QUERIES["op1_language_id"](spark, folder).join(
        spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right, n, low, high = got.where("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.min("score"), F.max("score")).first()
    assert n > 200 and right > 0.98 and 0 <= low and high <= 1


def test_whole_query_by_hand(spark, small):
    """Profiles, distances and predictions of every document by counters and lists."""
    rows = spark.read.parquet(f"{small}/documents.parquet").collect()
    own = {r.doc_id: by_hand(r.text or "") for r in rows}
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows}
    order = lambda counts: sorted(counts, key=lambda g: (-counts[g], g))[:400]
    languages = {}
    for r in rows:
        if r.text is not None and r.lang is not None and not held[r.doc_id]:
            languages.setdefault(r.lang, Counter()).update(own[r.doc_id])
    places = {x: {g: i for i, g in enumerate(order(c))} for x, c in languages.items()}
    got = queries.QUERIES["op1_language_id"](spark, small).collect()
    assert len(got) == len(rows) and len(places) > 1
    for r in got:
        grams = order(own[r.doc_id])
        far = {x: sum(min(400, abs(p[g] - i)) if g in p else 400 for i, g in enumerate(grams)) for x, p in places.items()}
        best = min(sorted(far), key=far.get)
        assert r.held_out == held[r.doc_id] and r.lang_pred == (best if grams else "und")
        assert abs(r.score - (1 - far[best] / (400 * len(grams)) if grams else 0)) < 1e-12
