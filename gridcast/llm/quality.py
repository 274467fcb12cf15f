"""Quality rules: text statistics, and a decision list learned from labelled statistics.

The list is learned by sequential covering.  Rules for the rarer class are found one after another: a rule grows from
nothing by the threshold condition with the best gain in information (FOIL's), is pruned from the end on rows kept
apart, is kept if it is better than the default there, and the rows it covers are taken out.  The list becomes one
ordered Spark conditional expression; no Python runs when it is applied.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.llm.common import ASCII_SPACE, small_batches, unused

SYMBOLS = "#*$%&|<>"
WINDOW = 3

#: The base statistics and what the rules may look at.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits",
          "n_long_words", "n_distinct_words")
#: Rule features: counts, and shares of one count in another.
SHARES = {
    "mean_word": ("word_chars", "n_words"), "symbol_share": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"), "digit_share": ("n_digits", "word_chars"),
    "long_share": ("n_long_words", "n_words"), "distinct_share": ("n_distinct_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}
FEATURES = (*COUNTS, *SHARES)


def repeat_words(words: list) -> int:
    """Words inside windows of three words that come twice or more, the first time included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    # exact: pairs are numbered first, then pairs with the third word
    _, pairs = np.unique(codes[:-1] * len(number) + codes[1:], return_inverse=True)
    _, where, times = np.unique(pairs[:-1] * len(number) + codes[2:], return_inverse=True, return_counts=True)
    again = times[where] > 1
    covered = np.zeros(len(words), bool)
    for k in range(WINDOW):
        covered[k:k + n] |= again
    return int(covered.sum())


def statistics(text: str | None) -> tuple[int, ...]:
    """The counts of ``COUNTS`` over a whole text; all zero for a null or empty text."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes fall apart at ASCII white space only
    chars = len(text) - sum(text.count(c) for c in ASCII_SPACE)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer(raw, np.uint8)
    return (
        len(words), chars, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeat_words(words),
        len(lines), int(((codes >= 65) & (codes <= 90)).sum()), int(((codes >= 48) & (codes <= 57)).sum()),
        int((sizes > 20).sum()), len(set(words)),
    )


STATISTICS = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])


def measured(docs: DataFrame, text: str = "text", into: str = "__stats") -> DataFrame:
    """``docs`` with the struct ``into`` of text statistics in front."""

    @F.pandas_udf(STATISTICS)
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([statistics(x) for x in batch], columns=list(COUNTS), dtype="int64")

    return small_batches(docs).select(measure(F.col(text)).alias(into), *[F.col(f"`{c}`") for c in docs.columns])


def feature(name: str, stats: str = "__stats") -> Column:
    """A rule feature as a column; a share of nothing is 0."""
    if name not in SHARES:
        return F.col(f"{stats}.{name}").cast("double")
    part, whole = (F.col(f"{stats}.{c}").cast("double") for c in SHARES[name])
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def base_failed(stats: str = "__stats") -> Column:
    words = F.col(f"{stats}.n_words")
    return (words < 50) | (100 * F.col(f"{stats}.n_repeat_words") > 50 * words)


Condition = tuple[str, bool, float]  # feature, True for >= and False for <, threshold


@dataclass
class Rule:
    conditions: list[Condition]
    covered: int
    right: int

    def column(self, stats: str = "__stats") -> Column:
        found = F.lit(True)
        for name, above, cut in self.conditions:
            value = feature(name, stats)
            found = found & ((value >= cut) if above else (value < cut))
        return found

    def __str__(self) -> str:
        return " and ".join(f"{n} {'>=' if a else '<'} {c:.6g}" for n, a, c in self.conditions)


@dataclass
class DecisionList:
    rules: list[Rule]  # each says ``target``
    target: int
    default: int

    def column(self, stats: str = "__stats") -> Column:
        """The predicted class as one ordered conditional expression."""
        if not self.rules:
            return F.lit(self.default)
        chain = None
        for rule in self.rules:
            says = F.lit(self.target)
            chain = F.when(rule.column(stats), says) if chain is None else chain.when(rule.column(stats), says)
        return chain.otherwise(F.lit(self.default))

    def __str__(self) -> str:
        return json.dumps({"rules": [str(r) for r in self.rules], "target": self.target, "default": self.default})


def _holds(x: dict[str, np.ndarray], condition: Condition) -> np.ndarray:
    name, above, cut = condition
    return x[name] >= cut if above else x[name] < cut


def _best_condition(x: dict[str, np.ndarray], y: np.ndarray, cuts: int) -> tuple[float, Condition | None]:
    """The threshold with the highest FOIL gain; ties go to the earlier feature and the lower threshold."""
    all_p, all_n = int(y.sum()), int((~y).sum())
    if not all_p or not all_n:
        return 0.0, None
    before, best, chosen = np.log2(all_p / (all_p + all_n)), 1e-9, None
    for name in FEATURES:
        values = x[name]
        points = np.unique(np.quantile(values, np.linspace(0, 1, cuts + 1), method="nearest"))[1:]
        if not len(points):
            continue
        where = np.searchsorted(points, values, side="right")  # rows with value >= points[k] have where > k
        p_at = np.bincount(where[y], minlength=len(points) + 1)
        n_at = np.bincount(where[~y], minlength=len(points) + 1)
        p_low, n_low = np.cumsum(p_at)[:-1], np.cumsum(n_at)[:-1]
        for above, p, n in ((True, all_p - p_low, all_n - n_low), (False, p_low, n_low)):
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / np.maximum(p + n, 1)) - before), -np.inf)
            k = int(np.argmax(gain))
            if gain[k] > best + 1e-9:
                best, chosen = float(gain[k]), (name, above, float(points[k]))
    return best, chosen


def _covered(x: dict[str, np.ndarray], conditions: list[Condition], rows: int) -> np.ndarray:
    hit = np.ones(rows, bool)
    for condition in conditions:
        hit &= _holds(x, condition)
    return hit


def learn(sample: pd.DataFrame, label: str, max_conditions: int = 4, max_rules: int = 24, cuts: int = 64,
          precision: float = 0.9) -> DecisionList:
    """A decision list from a frame with ``COUNTS`` and a 0/1 label.

    Every third row is kept apart for pruning.  A rule stays if on those rows at least ``precision`` of what it covers
    is right; the search ends at the first rule that fails.  Without rows, or with one class only, there are no rules.
    """
    y = sample[label].to_numpy(int) == 1
    target = int(y.sum() * 2 <= len(y))  # the rarer class
    if not len(y) or y.all() or not y.any():
        return DecisionList([], target, 1 if not len(y) else int(y.all()))
    with np.errstate(divide="ignore", invalid="ignore"):
        x = {c: sample[c].to_numpy(float) for c in COUNTS}
        x |= {c: np.where(x[b] > 0, x[a] / np.maximum(x[b], 1), 0.0) for c, (a, b) in SHARES.items()}
    hit = y == bool(target)
    apart = np.arange(len(y)) % 3 == 0
    rules: list[Rule] = []
    while len(rules) < max_rules:
        grow = {c: v[~apart] for c, v in x.items()}
        inside, conditions = np.ones(int((~apart).sum()), bool), []
        while len(conditions) < max_conditions:
            _, condition = _best_condition({c: v[inside] for c, v in grow.items()}, hit[~apart][inside], cuts)
            if condition is None:
                break
            conditions.append(condition)
            inside &= _holds(grow, condition)
        prune = {c: v[apart] for c, v in x.items()}
        best, kept = -np.inf, []
        for k in range(len(conditions), 0, -1):
            on = _covered(prune, conditions[:k], int(apart.sum()))
            p, n = int((on & hit[apart]).sum()), int((on & ~hit[apart]).sum())
            worth = (p - n) / (p + n) if p + n else -np.inf
            if worth >= best:
                best, kept = worth, conditions[:k]
        if not kept:
            break
        on = _covered(prune, kept, int(apart.sum()))
        p, n = int((on & hit[apart]).sum()), int((on & ~hit[apart]).sum())
        if p + n == 0 or p / (p + n) < precision:
            break
        on = _covered(x, kept, len(hit))
        rules.append(Rule(kept, int(on.sum()), int((on & hit).sum())))
        x, hit, apart = {c: v[~on] for c, v in x.items()}, hit[~on], apart[~on]
        if not hit.any():
            break
    return DecisionList(rules, target, 1 - target)


def learned_rules(labelled: DataFrame, label: str = "quality", text: str = "text", key: str = "doc_id", **how) -> DecisionList:
    """``learn`` over the statistics of the (bounded) labelled rows that pass the base rules, the only ones that the
    list decides; ordered by key hash, so that a run repeats."""
    stats = measured(labelled.where(F.col(label).isin(0, 1)), text).where(~base_failed())
    frame = stats.select(F.xxhash64(key).alias("order"), F.col(label).alias("label"), "__stats.*").toArrow().to_pandas()
    frame = frame.sort_values(list(frame.columns)).drop(columns=["order"])
    return learn(frame, "label", **how)


def judged(docs: DataFrame, rules: DecisionList, text: str = "text", into: str | None = None) -> DataFrame:
    """``docs`` with the struct ``into`` in front: the statistics, base_failed and kept.

    Without ``into`` its name is ``__quality``, or the like where a column has that.  ``kept`` is false where the base rules
    fail, else the list's verdict (class 1).  A null or empty text has no word and fails the base rules.  Repeated rows each
    get a result; an empty table gives an empty one; further columns stay as they are, whatever their names.
    """
    into = unused(docs.columns, "__quality") if into is None else into
    name = unused([*docs.columns, into], "__stats")
    stats = measured(docs, text, name)
    verdict = F.struct(
        *[F.col(f"{name}.{c}").alias(c) for c in COUNTS], base_failed(name).alias("base_failed"),
        (~base_failed(name) & (rules.column(name) == 1)).alias("kept"))
    return stats.select(verdict.alias(into), *[F.col(f"`{c}`") for c in docs.columns])
