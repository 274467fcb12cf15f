"""Toxic passages: maximum-scoring segments of token log-odds, with extreme-value statistics.

A token's log-odds compares its counts in toxic and clean documents under a symmetric Dirichlet prior; its score is
the log-odds less ``caution`` times its standard deviation, so a token that was seen a few times scores low.  Tokens
are hashed to a fixed number of buckets, so the model has the same size over any corpus, and every token counts.

Passages are the maximal scoring segments of the score sequence (linear time, all of them, disjoint); every token
counts wherever it stands, also where it comes again.  Over clean text, the best segment of n tokens exceeds S with
probability 1 - exp(-K n exp(-lambda S)).  ``lambda`` solves the equation sum p exp(lambda s) = 1 over the clean token
distribution, which takes tokens as independent; lines that repeat make the tail of real text longer, so ``lambda`` is
at most what fits the best segments of clean documents, and ``K`` is such that at most ``alpha`` of these documents have
a significant one.  A segment is significant where its expected number K n exp(-lambda S) is under ``alpha``.  A document's
evidence sums lambda S - ln(K n) over its significant segments (or takes its best one's), and a logistic function of
it is the score: its centre makes the fewest errors on labelled documents that were scored by the counts of the other
half.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.llm.common import checkpointed, text_slices, unused

#: Runs of ASCII characters that are neither letters nor digits part the tokens.
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
HALVES = 2


#: Tokens whose buckets a worker remembers.
KEPT = 1 << 18


class Buckets(dict):
    """The bucket of each token: its XXH64 (seed 42) modulo the number of buckets; -1 for the empty token."""

    def __init__(self, size: int):
        super().__init__({"": -1})
        self.size = size

    def __missing__(self, token: str) -> int:
        if len(self) > KEPT:
            self.clear()
            self[""] = -1
        self[token] = xxhash.xxh64_intdigest(token.encode(), 42) % self.size
        return self[token]

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of all texts' tokens, in order, and where each text starts; a null text has none."""
        lists = pc.split_pattern_regex(pc.utf8_lower(texts.fill_null("")), BREAK)
        tokens = lists.flatten().dictionary_encode()
        distinct = tokens.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = np.fromiter(map(self.__getitem__, distinct), np.int32, len(distinct))[tokens.indices.to_numpy()]
        there = found >= 0
        first = np.r_[0, np.cumsum(there)][lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        return found[there], first


def token_buckets(text: Column, buckets: int) -> Column:
    """The bucket of each token of the lower-cased text, in order; a null text has none."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Buckets(buckets)
        for batch in batches:
            parts = [known.of(part) for part in text_slices(batch)]
            lists = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(tokens)) for tokens, first in parts]
            yield pa.concat_arrays(lists) if lists else pa.array([], pa.list_(pa.int32()))

    return found(text)


def log_odds(toxic: np.ndarray, clean: np.ndarray, prior: float, caution: float) -> np.ndarray:
    """Cautious log-odds of each bucket from its counts in toxic and clean documents."""
    t, c, all_t, all_c = toxic + prior, clean + prior, toxic.sum() + prior * len(toxic), clean.sum() + prior * len(clean)
    odds = np.log(t / (all_t - t)) - np.log(c / (all_c - c))
    return (odds - caution * np.sqrt(1 / t + 1 / c)).astype(np.float32)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), end exclusive, in order of position.

    Runs of one sign are added up first: a maximal segment starts and ends with whole positive runs.  Then each
    positive run is joined with segments to its left as long as that raises the score (Ruzzo and Tompa's rule).  The
    search to the left goes from a segment straight to the nearest one before it with a smaller sum before it, so a run
    is passed over once at most, and the whole is linear in the number of runs.
    """
    positive = scores > 0
    if not positive.any():
        return []
    starts = np.flatnonzero(np.r_[True, positive[1:] != positive[:-1]])
    ends = np.r_[starts[1:], len(scores)]
    sums = np.add.reduceat(scores.astype(np.float64), starts)
    after = np.cumsum(sums)
    runs = np.flatnonzero(positive[starts])
    # first token, end, sum before the segment, sum at its end, nearest segment before with a smaller sum before it
    found: list[tuple[int, int, float, float, int]] = []
    for start, end, left, right in zip(*(x[runs].tolist() for x in (starts, ends, after - sums, after)), strict=True):
        at = len(found) - 1
        while True:
            while at >= 0 and found[at][2] >= left:
                at = found[at][4]
            if at < 0 or found[at][3] >= right:
                break
            start, left, before = found[at][0], found[at][2], found[at][4]
            del found[at:]
            at = before
        found.append((start, end, left, right, at))
    return [(a, b, r - x) for a, b, x, r, _ in found]


@dataclass
class Tail:
    """Extreme-value law of the best segment of clean text."""

    rate: float  # lambda
    k: float

    def evidence(self, score: float, n: int) -> float:
        return self.rate * score - float(np.log(self.k * max(n, 1)))


def decay_rate(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive solution of sum share * exp(rate * score) = 1 for scores of negative mean; 1 if there is none."""
    scores, share = scores.astype(np.float64), share.astype(np.float64)
    if not len(scores) or scores.max() <= 0 or float((scores * share).sum()) >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while float((share * np.exp(np.minimum(high * scores, 600))).sum()) < 1 and high < 1e6:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        if float((share * np.exp(np.minimum(middle * scores, 600))).sum()) < 1:
            low = middle
        else:
            high = middle
    return (low + high) / 2


def fitted_rate(best: np.ndarray, rows: np.ndarray, tokens: np.ndarray, most: float) -> float:
    """The likeliest rate, ``most`` at most, of the law of best segments: ``rows`` documents of ``tokens`` tokens in all
    have the best score ``best``.  It solves 1 / rate = mean score - mean score weighted by tokens * exp(-rate * score)."""
    mean, above = float((best * rows).sum() / rows.sum()), best - best.min()

    def short(rate: float) -> bool:
        weight = tokens * np.exp(-rate * above)
        return 1 / rate > mean - float((best * weight).sum() / weight.sum())

    low, high = 0.0, most
    if short(most):
        return most
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if short(middle) else (low, middle)
    return (low + high) / 2


@dataclass
class Model:
    scores: np.ndarray
    tail: Tail
    centre: float
    slope: float
    alpha: float

    def passages(self, tokens: np.ndarray) -> tuple[float, list[tuple[int, int, float]]]:
        """Evidence of a document and its significant passages (first token, end, expected number by chance)."""
        n, found = len(tokens), segments(self.scores[tokens])
        if not found:
            return self.tail.evidence(0.0, n), []
        each = [(a, b, self.tail.evidence(s, n)) for a, b, s in found]
        hot = [(a, b, float(np.exp(-e))) for a, b, e in each if e > -np.log(self.alpha)]
        total = sum(e for _, _, e in each if e > -np.log(self.alpha)) if hot else max(e for _, _, e in each)
        return float(total), hot

    def score(self, evidence: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * (evidence - self.centre), -50, 50))))


SCORED = T.StructType([
    T.StructField("score", T.DoubleType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("passages", T.ArrayType(T.StructType([
        T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType()),
        T.StructField("expected", T.DoubleType())]))),
])

FOUND = pa.struct([("score", pa.float64()), ("n_tokens", pa.int64()), ("passages", pa.list_(pa.struct([
    ("first", pa.int32()), ("end", pa.int32()), ("expected", pa.float64())])))])


def _segment_scores(tables: list[np.ndarray]):
    """UDF: scores of all segments by the table that the half names, and the number of tokens."""
    kind = T.StructType([T.StructField("each", T.ArrayType(T.DoubleType())), T.StructField("n", T.LongType())])

    @F.pandas_udf(kind)
    def each(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for tokens, half in batches:
            out = [([s for _, _, s in segments(tables[h][t])], len(t))
                   for t, h in zip(tokens, half, strict=True)]
            yield pd.DataFrame(out, columns=["each", "n"])

    return each


#: Best segments of clean documents count in the fit of the rate up to this quantile, so that a single wrong label does
#: not decide it; and by steps of their score, of which each has one row on the driver.
FIT_QUANTILE, FIT_STEPS = 0.995, 64


def _fitted_tail(clean: DataFrame, best: Column, rate: float, alpha: float) -> Tail:
    """The law of the best segments of ``clean`` (a score ``best`` and a number of tokens ``n`` of each document)."""
    top = clean.agg(F.percentile_approx(best, F.lit(FIT_QUANTILE), F.lit(10_000))).first()[0]
    if top is None:
        return Tail(rate, 1.0)
    capped = F.least(best, F.lit(top))
    steps = clean.groupBy(F.floor(capped * FIT_STEPS).alias("step")).agg(
        F.avg(capped).alias("best"), F.count(F.lit(1)).alias("rows"), F.sum("n").alias("tokens")
    ).toArrow().to_pandas().sort_values("step")
    rate = fitted_rate(*(steps[c].to_numpy(float) for c in ("best", "rows", "tokens")), rate)
    chance = F.col("n") * F.exp(-F.least(F.lit(rate) * best, F.lit(600.0)))
    mean, least = clean.agg(F.avg(chance), F.percentile_approx(chance, F.lit(alpha), F.lit(10_000))).first()
    return Tail(rate, max(1 / mean, alpha / least))


def learn(labelled: DataFrame, text: str = "text", label: str = "toxic", half: str = "half", buckets: int = 1 << 20,
          prior: float = 0.5, caution: float = 1.0, alpha: float = 0.05) -> Model:
    """A model from all ``labelled`` rows: text, label (0 or 1, others are left out) and half (0 or 1).

    A token counts once per document.  Counts come to the driver as one row per bucket, ``buckets`` at most.
    Without a toxic or a clean row no token scores, and every document gets a score under one half.
    """
    rows = checkpointed(
        labelled.where(F.col(label).isin(0, 1)).select(
            F.col(label).alias("toxic"), F.col(half).cast("int").alias("half"),
            token_buckets(F.col(text), buckets).alias("tokens"))
    )
    once = rows.select("toxic", "half", F.explode(F.array_distinct("tokens")).alias("bucket"))
    counted = once.groupBy("bucket").agg(*[
        F.count(F.when((F.col("toxic") == kind) & (F.col("half") == h), 1)).cast("int").alias(f"n{kind}{h}")
        for kind in (0, 1) for h in range(HALVES)
    ]).toArrow().to_pandas()
    table = np.zeros((2, HALVES, buckets), np.float32)  # numbers of documents of a bounded sample are exact
    for kind in (0, 1):
        for h in range(HALVES):
            table[kind, h, counted["bucket"].to_numpy(int)] = counted[f"n{kind}{h}"].to_numpy(float)
    whole = log_odds(table[1].sum(axis=0), table[0].sum(axis=0), prior, caution)
    if not table[1].any() or not table[0].any():
        return Model(np.full(buckets, -1, np.float32), Tail(1.0, 1.0), 1.0, 1.0, alpha)
    share = table[0].sum(axis=0) / table[0].sum()
    rate = decay_rate(whole.astype(float), share)
    crossed = [log_odds(table[1, 1 - h], table[0, 1 - h], prior, caution) for h in range(HALVES)]
    found = checkpointed(rows.select("toxic", _segment_scores(crossed)("tokens", "half").alias("s"))
                         .select("toxic", "s.*").where("n > 0"))
    best = F.greatest(F.lit(0.0), F.coalesce(F.array_max("each"), F.lit(0.0)))
    tail = _fitted_tail(found.where("toxic = 0"), best, rate, alpha)
    chance = F.log(F.lit(tail.k) * F.col("n"))
    hot = F.filter(F.transform("each", lambda s: s * tail.rate - chance), lambda e: e > float(-np.log(alpha)))
    evidence = F.when(F.size(hot) > 0, F.aggregate(hot, F.lit(0.0), lambda x, y: x + y)).otherwise(tail.rate * best - chance)
    steps = found.groupBy(F.floor(F.least(F.greatest(evidence, F.lit(-40.0)), F.lit(400.0)) * 4).alias("step")).agg(
        F.count(F.when(F.col("toxic") == 1, 1)).alias("t"), F.count(F.when(F.col("toxic") == 0, 1)).alias("c")
    ).toArrow().to_pandas().sort_values("step")
    return Model(whole, tail, *_logistic(steps), alpha)


def _logistic(steps: pd.DataFrame) -> tuple[float, float]:
    """Centre and slope: the cut with the fewest errors (the middle of the widest such stretch), and a slope that
    gives one bit of odds per unit of evidence at most."""
    step, toxic, clean = (steps[c].to_numpy(float) for c in ("step", "t", "c"))
    if not len(step):
        return 1.0, 1.0
    # errors of the cut before step k, for k from 0 to the number of steps
    errors = np.r_[0, np.cumsum(toxic)] + clean.sum() - np.r_[0, np.cumsum(clean)]
    best = np.flatnonzero(errors == errors.min())
    low = step[best[0] - 1] + 1 if best[0] > 0 else step[0] - 8
    high = step[best[-1]] if best[-1] < len(step) else step[-1] + 8
    return float((low + high) / 8), 0.7


def scored(docs: DataFrame, model: Model, text: str = "text", into: str | None = None) -> DataFrame:
    """``docs`` with the struct ``into`` in front: score, number of tokens, significant passages by token.

    Without ``into`` its name is ``__toxicity``, or the like where a column has that.  A null or empty text has no token,
    no passage and a score under one half.  Only the text is an input.  Repeated rows each get a result; an empty table
    gives an empty one; further columns stay as they are, whatever their names.
    """
    into = unused(docs.columns, "__toxicity") if into is None else into

    @F.arrow_udf(SCORED)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Buckets(len(model.scores))
        for batch in batches:
            out = []
            for part in text_slices(batch):
                tokens, first = known.of(part)
                for start, end in zip(first, first[1:], strict=False):
                    evidence, hot = model.passages(tokens[start:end])
                    out.append({"score": model.score(evidence) if end > start else 0.0, "n_tokens": int(end - start),
                                "passages": [{"first": a, "end": b, "expected": e} for a, b, e in hot]})
            yield pa.array(out, FOUND)

    return docs.select(judge(F.col(f"`{text}`")).alias(into), *[F.col(f"`{c}`") for c in docs.columns])
