"""Licence scans by a positional index of rare words.

Templates are short public licence notices with mandatory phrases.  The index holds, for each template, the words of
its mandatory phrases with the highest inverse document frequency in the corpus, at their places in the template.
A file's words are looked up in it: each occurrence of a template's rarest word proposes where the template would
start, the next rare words must stand at their relative places, and every mandatory phrase is verified word by word.
A verified place needs its rarest word, so none is missed.  All of it is one pass without a shuffle, after a pass
that counts the licence words' documents (one row per licence word).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import ascii_lower

#: Characters that part words: ASCII but for digits and lower-case letters (texts are lower-cased first).
BREAKS = "".join(chr(c) for c in range(128) if not (48 <= c <= 57 or 97 <= c <= 122))
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """``phrases`` are stretches of ``text`` that must be there; ``base`` ones are counted at all their places."""

    label: str
    text: str
    phrases: tuple[str, ...]
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def mandatory(self) -> list[tuple[int, list[str]]]:
        """(place in the template, words) of each phrase."""
        found = []
        for phrase in self.phrases:
            words = phrase.split()
            at = next(k for k in range(len(self.words)) if self.words[k:k + len(words)] == words)
            found.append((at, words))
        return found

    def rare(self, idf: dict[str, float], count: int) -> list[tuple[str, int]]:
        """The mandatory words with the highest idf and their places, rarest first; ties by word."""
        places = {}
        for at, words in self.mandatory:
            for k, word in enumerate(words):
                places.setdefault(word, at + k)
        return sorted(places.items(), key=lambda x: (-idf[x[0]], x[0]))[:count]


# Phrases of public licence notices, lower-cased and without punctuation.
BASE = (
    Template("cc-by", "cc by", ("cc by",), True),
    Template("gpl", "general public license", ("general public license",), True),
    Template("reserved", "all rights reserved", ("all rights reserved",), True),
)
NOTICES = (
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software "
             "and associated documentation files", ("permission is hereby granted", "free of charge", "obtaining a copy")),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             ("redistribution and use", "source and binary forms")),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3",
             ("gnu general public license version 3",)),
    Template("gpl-2.0", "this work is licensed under the gnu general public license version 2",
             ("gnu general public license version 2",)),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose",
             ("permission to use copy modify", "for any purpose")),
)
TEMPLATES = BASE + NOTICES


def licence_words(text: Column) -> Column:
    """Words of the lower-cased text: runs of a-z, 0-9 and characters beyond ASCII; a null text has none."""
    trimmed = F.btrim(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(BREAKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BREAK))


def document_frequencies(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, text: str = "text") -> dict[str, float]:
    """Inverse document frequency of every mandatory word over all rows; one row per such word comes to the driver."""
    vocabulary = sorted({w for t in templates for _, words in t.mandatory for w in words})
    found = F.array_distinct(F.filter(licence_words(F.col(text)), lambda w: w.isin(vocabulary)))
    counts = docs.select(F.explode(F.concat(F.array(F.lit("")), found)).alias("word")).groupBy("word").count().collect()
    seen = {r["word"]: r["count"] for r in counts}
    return {w: math.log((1 + seen.get("", 0)) / (1 + seen.get(w, 0))) for w in vocabulary}


def _places(template: Template, rare: list[tuple[str, int]]) -> Column:
    """Verified starts of the template, from the places ``at`` of rare words in ``words`` (a start may lie before 0)."""
    words = F.col("words")
    anchor, place = rare[0]
    starts = F.transform(F.filter("at", lambda i: F.get(words, i) == anchor), lambda i: i - place)

    def verified(start: Column) -> Column:
        found = F.lit(True)
        for word, q in rare[1:]:  # intersect the postings by relative position
            found = found & F.coalesce(F.get(words, start + q) == word, F.lit(False))
        for at, phrase in template.mandatory:  # the phrases word by word
            for k, word in enumerate(phrase):
                found = found & F.coalesce(F.get(words, start + at + k) == word, F.lit(False))
        return found

    return F.filter(starts, verified)


def _share(template: Template, places: str) -> Column:
    """The largest share of the template's words that stand at a verified place; null without a place."""
    words, own = F.col("words"), template.words
    one = F.transform(places, lambda s: sum(
        (F.coalesce(F.get(words, s + q) == w, F.lit(False)).cast("int") for q, w in enumerate(own)), F.lit(0)))
    return F.array_max(one) / F.lit(float(len(own)))


def _spans(template: Template, places: str) -> Column:
    return F.transform(places, lambda s: F.struct(
        F.lit(template.label).alias("label"), s.alias("start"), F.lit(len(template.words)).alias("words")))


def scan(docs: DataFrame, idf: dict[str, float], templates: tuple[Template, ...] = TEMPLATES, rare_words: int = 2,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, score, places) of every row.

    ``places`` lists (label, start word, words) of every verified place, in template order.  A null or empty text has
    no word, no label (an empty string) and score 0; first_word and last_word are null without a base place.  Repeated
    rows each get a result; an empty table gives an empty one; further columns are not read.
    """
    index = {t: t.rare(idf, rare_words) for t in templates}
    anchors = sorted({found[0][0] for found in index.values()})
    worded = docs.select(F.col(key).alias("key"), licence_words(F.col(text)).alias("words"))
    looked = worded.select("key", "words", F.array_compact(
        F.transform("words", lambda w, i: F.when(w.isin(anchors), i))).alias("at"))
    name = {t: f"p{k}" for k, t in enumerate(templates)}
    placed = looked.select("key", "words", *[_places(t, index[t]).alias(name[t]) for t in templates])
    base = [t for t in templates if t.base]
    shares = [F.coalesce(_share(t, name[t]), F.lit(0.0)) for t in templates]

    def labels(of) -> Column:
        each = F.array(*[F.when(F.size(name[t]) > 0, F.lit(t.label)) for t in of])
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(each))), ",")

    starts = F.concat(*[F.col(name[t]) for t in base])
    every = F.concat(*[_spans(t, name[t]) for t in templates])
    return placed.select(
        F.col("key").alias(key), F.size("words").cast("long").alias("n_words"), F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(templates).alias("labels"), F.greatest(*shares).alias("score"),
        every.alias("places"))


def scan_sql() -> str:
    """The same rows (without ``places``) for DuckDB: every template word votes for a start, and a start is verified
    where all mandatory words vote."""
    def rows(of):
        return ", ".join(f"({k}, '{t.label}', {str(t.base).lower()}, {q}, '{w}', "
                         f"{str(any(a <= q < a + len(p) for a, p in t.mandatory)).lower()}, {len(t.words)})"
                         for k, t in enumerate(of) for q, w in enumerate(t.words))
    return f"""
WITH tw(t, label, base, q, w, must, len) AS (VALUES {rows(TEMPLATES)}),
need AS (SELECT t, count(*) AS n FROM tw WHERE must GROUP BY t),
lists AS (SELECT doc_id, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i FROM lists),
votes AS (SELECT doc_id, t, label, base, i - q AS start, count(*) FILTER (WHERE must) AS n_must,
          count(*) / CAST(max(len) AS DOUBLE) AS share
          FROM words JOIN tw USING (w) GROUP BY ALL),
places AS (SELECT v.* FROM votes v JOIN need USING (t) WHERE n_must = n),
found AS (SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word,
  max(start) FILTER (WHERE base) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
  string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM places GROUP BY doc_id)
SELECT l.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM lists l LEFT JOIN found USING (doc_id)"""
