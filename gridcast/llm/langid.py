"""Language identification by rank-order n-gram profiles.

A text's letters, lower-cased, form words padded with one blank; its n-grams of one to three characters (a blank
only at an end) are ranked by frequency, ties by code.  The distance to a language profile is the sum over the
text's first ``size`` n-grams of how far out of place each one is, ``size`` for one the profile lacks.

Learning counts the n-grams of every training text: tasks add up the counts of their own rows, Spark adds those of
the tasks, and the most frequent ``size`` per language are kept, first within salted parts of a language and then of
the parts.  The profiles hold ``size`` rows per language, and their number of languages is checked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.llm.common import small_batches, unused

BLANK, SHIFT, TOP = 32, 21, 0x110000
#: Parts of a text's code points that are counted at a time, so a very long text needs no more memory.
CHUNK = 1 << 20
#: Distinct n-grams that a task holds before it passes its counts on.
HELD = 1 << 18

Counts = tuple[np.ndarray, np.ndarray]
NONE: Counts = (np.zeros(0, np.int64), np.zeros(0, np.int64))


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point whether it is a letter; made once where it is used (a cached function does not travel)."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(TOP)), bool, TOP))
    return _LETTERS[0]


def _ngrams(codes: np.ndarray) -> np.ndarray:
    """Codes of all n-grams of a blank-padded stretch of words; each code holds its characters in 21 bits each."""
    c = codes.astype(np.int64)
    solid = c != BLANK
    two = (c[:-1] << SHIFT) | c[1:]
    three = (two[:-1] << SHIFT) | c[2:]
    return np.concatenate([c[solid], two, three[solid[1:-1]]])


def added(parts: list[Counts]) -> Counts:
    codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(where, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)


def count_ngrams(text: str | None, chunk: int = CHUNK) -> Counts:
    """Distinct n-grams of a whole text and their numbers; none if it has no letter.

    A chunk starts with the last two code points of the one before, so n-grams over the cut are counted once.
    """
    if not text:
        return NONE
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    solid = _letters()[np.minimum(codes, TOP - 1)]
    if not solid.any():
        return NONE
    after = np.r_[False, solid[:-1]]
    line = np.r_[np.uint32(BLANK), np.where(solid, codes, np.uint32(BLANK))[solid | after]]
    line = line if line[-1] == BLANK else np.r_[line, np.uint32(BLANK)]
    if len(line) <= chunk:
        return tuple(np.unique(_ngrams(line), return_counts=True))
    parts = []
    for start in range(0, len(line) - 2, chunk):
        piece = line[start:start + chunk + 2]
        grams = _ngrams(piece)
        if start + chunk + 2 < len(line):  # the last two characters and the last pair come again with the next piece
            own = [int(x) for x in piece[-2:] if x != BLANK] + [int(piece[-2]) << SHIFT | int(piece[-1])]
            codes_, n = np.unique(grams, return_counts=True)
            for gram in own:
                n[np.searchsorted(codes_, gram)] -= 1
            parts.append((codes_[n > 0], n[n > 0]))
        else:
            parts.append(tuple(np.unique(grams, return_counts=True)))
    return added(parts)


def ranked(counts: Counts, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, most frequent first, ties by code."""
    codes, n = counts
    return codes[np.lexsort((codes, -n))[:size]]


class Profiles:
    """The ranked n-grams of each language, sorted by code for look-up."""

    def __init__(self, tables: dict[str, np.ndarray], size: int):
        self.size, self.languages = size, sorted(tables)
        self.orders = [np.argsort(tables[x], kind="stable") for x in self.languages]
        self.codes = [tables[x][o] for x, o in zip(self.languages, self.orders, strict=True)]

    def distances(self, grams: np.ndarray) -> list[float]:
        """Out-of-place distance to each language as a share of the largest possible."""
        places, found = np.arange(len(grams)), []
        for codes, order in zip(self.codes, self.orders, strict=True):
            at = np.minimum(np.searchsorted(codes, grams), max(0, len(codes) - 1))
            hit = codes[at] == grams if len(codes) else np.zeros(len(grams), bool)
            out = np.full(len(grams), self.size)
            out[hit] = np.minimum(np.abs(order[at[hit]] - places[hit]), self.size)
            found.append(float(out.sum()) / (self.size * len(grams)))
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language (ties: the first by name) and 1 less its distance; ``und`` and 0 without a letter or a profile."""
        grams = ranked(count_ngrams(text), self.size)
        if not len(grams) or not self.languages:
            return "und", 0.0
        distances = self.distances(grams)
        best = int(np.argmin(distances))
        return self.languages[best], 1.0 - distances[best]


def _count_tasks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, list[Counts]] = {}

    def handed() -> Iterator[pd.DataFrame]:
        for language, parts in held.items():
            codes, n = added(parts)
            yield pd.DataFrame({"lang": language, "gram": codes, "n": n})
        held.clear()

    size = 0
    for batch in batches:
        for text, language in zip(batch["text"], batch["lang"], strict=True):
            counts = count_ngrams(text)
            held.setdefault(language, []).append(counts)
            size += len(counts[0])
            if size > 4 * HELD:
                held = {x: [added(parts)] for x, parts in held.items()}
                size = sum(len(p[0][0]) for p in held.values())
                if size > HELD:
                    yield from handed()
                    size = 0
    yield from handed()


def learn(docs: DataFrame, size: int = 400, text: str = "text", lang: str = "lang", salts: int = 16,
          max_languages: int = 4096) -> Profiles:
    """Profiles from every row with text and language.  Over ``max_languages`` languages raise an error: their
    profiles are sent to all tasks, and must be few."""
    rows = small_batches(docs).select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    counts = rows.mapInPandas(_count_tasks, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))

    def first(df: DataFrame, *keys: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "gram"))
        return df.withColumn("place", place).where(F.col("place") <= size)

    salted = counts.withColumn("salt", F.pmod(F.xxhash64("gram"), F.lit(salts)))
    top = first(first(salted, "lang", "salt"), "lang").select("lang", "gram", "place")
    found = top.limit(size * max_languages + 1).toArrow().to_pandas()
    if len(found) > size * max_languages:
        raise ValueError(f"over {max_languages} languages")
    found = found.sort_values(["lang", "place"])
    return Profiles({x: g["gram"].to_numpy(np.int64) for x, g in found.groupby("lang")}, size)


def predicted(text: Column, profiles: Profiles) -> Column:
    """Struct (lang_pred, score) for each text."""
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(kind)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([profiles.predict(x) for x in batch], columns=["lang_pred", "score"])

    return predict(text)


def identify(docs: DataFrame, profiles: Profiles, text: str = "text", into: str | None = None) -> DataFrame:
    """``docs`` with the struct column ``into`` (lang_pred, score) in front; further columns stay as they are.

    Without ``into`` its name is ``__language``, or the like where a column has that.  Null texts, empty texts and texts
    without a letter are ``und`` with score 0.  Repeated rows each get a result; an empty table gives an empty one.  Only
    the text is an input of the prediction.
    """
    into = unused(docs.columns, "__language") if into is None else into
    found = predicted(F.col(f"`{text}`"), profiles).alias(into)
    return small_batches(docs).select(found, *[F.col(f"`{c}`") for c in docs.columns])
