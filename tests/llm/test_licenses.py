"""Licence places against brute force over all templates and starts."""

import re
from collections import Counter

import pytest

from gridcast.llm import licenses

TEXTS = [
    (1, None), (2, ""), (3, "!!! \x00"), (4, "CC-BY. cc by? CC  BY"), (5, "General\nPublic,License"), (6, "all rights reserved"),
    (7, "MIT License"), (8, "released under the MIT license"), (9, "Licensed under CC BY-NC 4.0"),
    (10, "This work is licensed under the GNU General Public License, version 3."), (11, "gnu general public license version"),
    (12, "éall rights reservedé all rights ÀB reserved"), (13, "cc by"), (13, "cc by"), (None, "all rights reserved"),
    (14, "Licensed under the Apache License, Version 2.0 and the MIT License"), (15, "by cc by cc by cc"),
    (16, "Redistribution and use in source and binary forms, with or without modification"),
    (17, "redistribution and use in the source and binary forms"), (18, "license " * 20 + "word " * 300_000 + "all rights reserved"),
]


def by_hand(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    at = lambda i: words[i] if 0 <= i < len(words) else None
    where = {}
    for i, w in enumerate(words):
        where.setdefault(w, []).append(i)
    starts, base, labels, score = [], set(), set(), 0.0
    for t in licenses.TEMPLATES:
        first, phrase = t.mandatory[0]
        for i in where.get(phrase[0], []):
            s = i - first
            if all(at(s + a + k) == w for a, p in t.mandatory for k, w in enumerate(p)):
                labels.add(t.label)
                score = max(score, sum(at(s + q) == w for q, w in enumerate(t.words)) / len(t.words))
                if t.base:
                    base.add(t.label)
                    starts.append(s)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), score)


COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@pytest.mark.parametrize("rare", [1, 2, 9])
def test_places(docs_of, rare):
    docs = docs_of(TEXTS)
    got = licenses.scan(docs, licenses.document_frequencies(docs), rare_words=rare)
    assert got.columns == ["doc_id", *COLUMNS, "places"]
    assert Counter((r.doc_id, *[r[c] for c in COLUMNS]) for r in got.collect()) == Counter((k, *by_hand(t)) for k, t in TEXTS)


def test_spans(docs_of):
    docs = docs_of([(1, "x all rights reserved y MIT License")])
    row = licenses.scan(docs, licenses.document_frequencies(docs)).first()
    assert [(p.label, p.start, p.words) for p in row.places] == [("reserved", 1, 3), ("mit", 2, 5)]


def test_frequencies_count_documents(docs_of):
    idf = licenses.document_frequencies(docs_of([(1, "cc cc cc"), (2, "cc by"), (3, None)]))
    assert idf["cc"] < idf["by"] < idf["mozilla"]
    assert set(licenses.document_frequencies(docs_of([(1, "a")]).where("false")).values()) == {0.0}


def test_empty_table(docs_of):
    docs = docs_of(TEXTS).where("false")
    assert licenses.scan(docs, licenses.document_frequencies(docs)).collect() == []


def test_one_pass_without_python_or_shuffle(docs_of):
    docs = docs_of(TEXTS)
    plan = licenses.scan(docs, licenses.document_frequencies(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
