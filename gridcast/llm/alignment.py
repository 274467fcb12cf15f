"""Alignment of two tokenizers over the bytes of a text.

Both encode a space and the text, and every token covers a range of its bytes.  ``pandas.merge_asof``, a batch at a time
and keyed by document, finds for each token start the token of the other side that covers it; the union of both
directions has every overlap, since of two tokens that overlap one starts inside the other.  Overlaps with equal ends are
the links, and they cut the tokens into groups.

Where two tokens end together the shorter one's bytes end the longer one's.  So a linked pair is told by the longer
token and the length of the shorter, and a table over all pairs that can be linked has one entry for each byte of the
two vocabularies, however large the corpus.  Pair counts over the corpus are such a table.

A space between two characters that are not white space starts a token on both sides (checked when the vocabularies are
read), so the words between such spaces are encoded one by one, and a worker keeps what it has encoded.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.llm.common import shipped, text_slices
from gridcast.session import stage

MARK = "▁"
# How byte-level vocabularies split a text before any merge.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A space that starts a token.
BETWEEN = re.compile(r"(?<=\S) (?=\S)")
#: Characters whose tokens a task holds at a time (but for one longer text), and words that a worker keeps.
SLICE, KEPT = 1 << 19, 1 << 18


def byte_level_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 stands for itself, and the
    other bytes, in order, for the letters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@dataclass
class ByteLevel:
    """A byte-level BPE vocabulary (JSON file); encodes the text that it is given."""

    source: str
    texts: list[bytes] = field(init=False)
    by_words: bool = field(init=False)

    def __post_init__(self):
        said = json.loads(self.source)
        letters = byte_level_letters()
        vocabulary = said["model"]["vocab"]
        self.texts = [b""] * (1 + max([*vocabulary.values(), *(t["id"] for t in said["added_tokens"])]))
        for text, k in vocabulary.items():
            self.texts[k] = bytes(letters[c] for c in text)
        split = said["pre_tokenizer"] or {}
        self.by_words = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not said["normalizer"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in said["model"]["merges"]]
        made = [vocabulary.get(a + b, -1) for a, b in merges]
        # ids in the order of the merges are ranks: the merge rule of the faster library
        self.ranked = (self.by_words and not split.get("add_prefix_space") and made == sorted(set(made))
                       and all(c in vocabulary for c in letters) and len(made) + len(letters) == len(vocabulary))
        self._coder = None

    def __getstate__(self):
        return {**self.__dict__, "_coder": None}

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self._coder is None:
            if self.ranked:
                ranks = {t: k for k, t in enumerate(self.texts) if t}
                self._coder = tiktoken.Encoding("own", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
            else:
                self._coder = tokenizers.Tokenizer.from_str(self.source)
                self._coder.encode_special_tokens = True
        if self.ranked:
            return [self._coder.encode_ordinary(t) for t in texts]
        return [self._coder.encode(t, add_special_tokens=False).ids for t in texts]


@dataclass
class Pieces:
    """A SentencePiece model; encodes a text that starts with a space, which the model adds itself."""

    source: bytes
    texts: list[bytes] = field(init=False)
    by_words: bool = field(init=False)
    single: np.ndarray = field(init=False)  # is a byte token

    def __post_init__(self):
        model = sentencepiece.SentencePieceProcessor(model_proto=self.source)
        ids = range(model.get_piece_size())
        self.single = np.array([model.is_byte(k) for k in ids])
        self.texts = [
            b"" if model.is_control(k) or model.is_unknown(k) or model.is_unused(k)
            else bytes([int(model.id_to_piece(k)[3:5], 16)]) if self.single[k]
            else model.id_to_piece(k).replace(MARK, " ").encode() for k in ids]
        self.by_words = not any(MARK in model.id_to_piece(k).lstrip(MARK) for k in ids)
        self._coder = None

    def __getstate__(self):
        return {**self.__dict__, "_coder": None}

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self._coder is None:
            self._coder = sentencepiece.SentencePieceProcessor(model_proto=self.source)
        return self._coder.encode([t[1:] for t in texts], num_threads=1)


def _lengths(texts: list[bytes]) -> np.ndarray:
    return np.array([len(t) for t in texts], np.int64)


class Pairs:
    """Numbers for the pairs of tokens that can end together.

    With A's token the longer (or as long), ``2 * (bytes of all A tokens before it + length of B's - 1)``, plus one if
    B's is a byte token; else the same after all of these with the sides changed.
    """

    def __init__(self, a: ByteLevel, b: Pieces):
        self.long_a, self.long_b, self.single = _lengths(a.texts), _lengths(b.texts), b.single
        self.before_a = np.r_[0, np.cumsum(self.long_a)]
        self.before_b = np.r_[0, np.cumsum(self.long_b)] + self.before_a[-1]
        self.size = 2 * int(self.before_b[-1])

    def number(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of each pair of ids whose tokens end together."""
        x, y = self.long_a[a], self.long_b[b]
        longer = np.where(x >= y, self.before_a[a] + y, self.before_b[b] + x)
        return (2 * longer - 2 + (self.single[b] & (x >= y))).astype(np.int32)

    def b_ids(self, a: ByteLevel, b: Pieces) -> np.ndarray:
        """The id of B in each pair; -1 where no token has the bytes."""
        out = np.full(self.size, -1, np.int32)
        for single in (0, 1):
            named = {t: k for k, t in enumerate(b.texts) if t and bool(self.single[k]) == bool(single)}
            for k, text in enumerate(a.texts):
                for size in range(1, len(text) + 1):
                    found = named.get(text[-size:])
                    if found is not None:
                        out[2 * (self.before_a[k] + size - 1) + single] = found
        for k, text in enumerate(b.texts):
            out[2 * self.before_b[k]:2 * self.before_b[k + 1]:2] = k if text else -1
        return out


@dataclass
class Side:
    """Tokens of a batch of documents: ids, and the document and byte range of each (bytes counted over the batch)."""

    ids: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # of each document, and the end

    def frame(self, name: str) -> pd.DataFrame:
        return pd.DataFrame({"doc": self.doc, "start": self.start, name: np.arange(len(self.ids))}, copy=False)


@dataclass
class Aligned:
    a: Side
    b: Side
    over_b: np.ndarray  # the B token that covers the start of each A token
    over_a: np.ndarray  # the A token that covers the start of each B token
    last_a: np.ndarray  # last A token of each group
    last_b: np.ndarray  # last B token of each group

    def overlaps(self) -> np.ndarray:
        """(a, b) of all tokens that share a byte, by position."""
        there = np.c_[np.arange(len(self.over_b)), self.over_b]
        back = np.c_[self.over_a, np.arange(len(self.over_a))]
        return np.unique(np.concatenate([there, back]), axis=0)


def aligned_batch(a: Side, b: Side) -> Aligned:
    left, right = a.frame("a"), b.frame("b")
    over_b = pd.merge_asof(left, right, on="start", by="doc")["b"].to_numpy(np.int64)
    over_a = pd.merge_asof(right, left, on="start", by="doc")["a"].to_numpy(np.int64)
    partner = np.full(len(a.ids), -1, np.int64)
    equal = np.flatnonzero(a.end == b.end[over_b])
    partner[equal] = over_b[equal]
    equal = np.flatnonzero(b.end == a.end[over_a])
    partner[over_a[equal]] = equal
    last_a = np.flatnonzero(partner >= 0)
    return Aligned(a, b, over_b, over_a, last_a, partner[last_a])


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers from ``first`` on, ``size`` of them, for each entry in turn."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)


class _Words(dict):
    """A number for each word; new ones wait to be encoded."""

    def __init__(self):
        super().__init__()
        self.waiting: list[str] = []

    def __missing__(self, word: str) -> int:
        self.waiting.append(word)
        self[word] = len(self)
        return self[word]


class Aligner:
    """Encodes and aligns batches of texts; every Python worker has one of its own."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b, self.pairs = a, b, Pairs(a, b)
        self.by_words = a.by_words and b.by_words
        self._forget()
        self._printed = None

    def __getstate__(self):
        return {**self.__dict__, "words": None, "ids": None, "_printed": None}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    def _forget(self):
        self.words = _Words()
        none = np.zeros(0, np.int32)
        self.ids = {"a": none, "b": none}  # of all words, one after the other
        self.first = {"a": np.zeros(1, np.int64), "b": np.zeros(1, np.int64)}
        self.whole = np.zeros(0, bool)  # both sides give the bytes of the word back
        self.odd = np.zeros(0, bool)  # no word by itself: empty, or with white space at an end

    def _encode_waiting(self):
        waiting, self.words.waiting = self.words.waiting, []
        if not waiting:
            return
        texts, good = [" " + w for w in waiting], np.ones(len(waiting), bool)
        for name, side in (("a", self.a), ("b", self.b)):
            found, spelt = side.encode(texts), side.texts.__getitem__
            good &= np.fromiter((b"".join(map(spelt, ids)) == t.encode() for ids, t in zip(found, texts, strict=True)), bool)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            new = np.fromiter(itertools.chain.from_iterable(found), np.int32, int(sizes.sum()))
            self.ids[name] = np.concatenate([self.ids[name], new])
            self.first[name] = np.r_[self.first[name], self.first[name][-1] + np.cumsum(sizes)]
        self.whole = np.r_[self.whole, good]
        self.odd = np.r_[self.odd, [not w or w[0].isspace() or w[-1].isspace() for w in waiting]]

    def _numbered(self, words: pa.Array) -> np.ndarray:
        """The number of each word."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(self.words.__getitem__, distinct), np.int64, len(distinct))
        self._encode_waiting()
        return numbers[coded.indices.to_numpy()]

    def encoded(self, texts: pa.Array) -> tuple[Side, Side]:
        """Both sides' tokens of a batch of texts without nulls.  A text that is empty, or that one side does not give
        back, has none."""
        if len(self.words) > KEPT:
            self._forget()
        if self.by_words:
            words = pc.split_pattern(texts, " ")
            first = words.offsets.to_numpy() - words.offsets[0].as_py()
            found = self._numbered(words.flatten())
        else:
            first, found = np.arange(len(texts) + 1), self._numbered(texts)
        if self.by_words and self.odd[found].any():
            # white space beside a space: there the tokens of either side may run over it
            strange = np.add.reduceat(self.odd[found], first[:-1]) > 0
            sizes, again = np.diff(first), []
            for k in np.flatnonzero(strange).tolist():
                own = BETWEEN.split(texts[k].as_py())
                sizes[k] = len(own)
                again += own
            kept = np.repeat(strange, sizes)
            new = np.empty(int(sizes.sum()), np.int64)
            new[~kept] = found[np.repeat(~strange, np.diff(first))]
            new[kept] = self._numbered(pa.array(again, texts.type))
            found, first = new, np.r_[0, np.cumsum(sizes)]
        sizes = np.diff(first)
        bad = np.add.reduceat(~self.whole[found], first[:-1]) > 0 if len(texts) else np.zeros(0, bool)
        bad |= pc.equal(texts, "").to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(texts)), sizes)
        use = ~bad[doc]
        found, doc = found[use], doc[use]
        sides = []
        for name, long in (("a", self.pairs.long_a), ("b", self.pairs.long_b)):
            start, many = self.first[name][found], self.first[name][found + 1] - self.first[name][found]
            ids = self.ids[name][_ranges(start, many)]
            ends = np.cumsum(long[ids])
            docs = np.repeat(doc, many)
            sides.append(Side(ids, docs, ends - long[ids], ends, np.searchsorted(docs, np.arange(len(texts) + 1))))
        return sides[0], sides[1]

    def aligned(self, texts: pa.Array) -> Aligned:
        return aligned_batch(*self.encoded(texts))

    def links(self, found: Aligned) -> np.ndarray:
        """The pair number of each link."""
        return self.pairs.number(found.a.ids[found.last_a], found.b.ids[found.last_b])

    def printed(self, found: Aligned) -> Iterator[str]:
        """The groups of each document: ``a1,a2|b1;a3|b2,b3`` by id."""
        if self._printed is None:
            size = max(len(self.a.texts), len(self.b.texts))
            self._printed = np.array([f"{k}{mark}" for mark in ",|;" for k in range(size)], object)
        size, a, b = len(self._printed) // 3, found.a, found.b
        sign_a, sign_b = a.ids.astype(np.int64), b.ids.astype(np.int64)
        sign_a[found.last_a] += size
        sign_b[found.last_b] += 2 * size
        signs = np.empty(len(sign_a) + len(sign_b), np.int64)
        group_a = np.r_[0, np.cumsum(np.bincount(found.last_a, minlength=len(sign_a)))[:-1]] if len(sign_a) else sign_a
        group_b = np.r_[0, np.cumsum(np.bincount(found.last_b, minlength=len(sign_b)))[:-1]] if len(sign_b) else sign_b
        signs[np.arange(len(sign_a)) + np.r_[0, found.last_b + 1][group_a]] = sign_a
        signs[np.arange(len(sign_b)) + (found.last_a + 1)[group_b]] = sign_b
        texts, cuts = self._printed[signs], (a.first + b.first).tolist()
        for start, end in zip(cuts, cuts[1:], strict=False):
            yield "".join(texts[start:end].tolist())[:-1]


def load(byte_level: str, pieces: str) -> Aligner:
    """Read both vocabularies (on the driver; executors get them by broadcast)."""
    with open(byte_level, encoding="utf-8") as file:
        a = ByteLevel(file.read())
    with open(pieces, "rb") as file:
        return Aligner(a, Pieces(file.read()))


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values))


def _mapped(docs: DataFrame, aligner: Aligner, keys: tuple[str, ...], text: str, results, fields: list) -> DataFrame:
    """``key0, key1...`` of every row with what ``results(aligner, aligned batch)`` gives for it."""
    shared = shipped(docs.sparkSession, aligner)
    rows = docs.select(*[F.col(f"`{k}`").alias(f"key{i}") for i, k in enumerate(keys)], F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keys)).fill_null("")
            start = 0
            for part in text_slices(texts, SLICE):
                columns = results(shared.value, shared.value.aligned(part))
                own = [batch.column(k).slice(start, len(part)) for k in range(len(keys))]
                start += len(part)
                yield pa.RecordBatch.from_arrays([*own, *columns], names=[f.name for f in schema.fields])

    schema = T.StructType([*rows.schema.fields[:-1], *fields])
    return rows.mapInArrow(run, schema)


def _named(found: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return found.toDF(*keys, *found.columns[len(keys):])


def aligned(docs: DataFrame, aligner: Aligner, keys: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ``keys`` of every row with its alignment.

    ``a_ids`` and ``b_ids`` are the tokens; ``overlaps`` the places (a, b) of all tokens that share a byte; ``groups`` the
    places of the last tokens of each group, which end together.  A text that is null, empty, or that one of the sides
    does not give back byte for byte has empty arrays.  Repeated rows each get a result, an empty table gives an empty one;
    further columns are not read.
    """

    def results(_, found: Aligned) -> list[pa.Array]:
        over = found.overlaps()
        cut = np.searchsorted(over[:, 0], found.a.first)
        doc = found.a.doc[over[:, 0]]
        both = [over[:, 0] - found.a.first[doc], over[:, 1] - found.b.first[doc]]
        last = [found.last_a - found.a.first[found.a.doc[found.last_a]], found.last_b - found.b.first[found.a.doc[found.last_a]]]
        ends = np.searchsorted(found.last_a, found.a.first)

        def pairs(values, first):
            names = pa.struct([("a", pa.int32()), ("b", pa.int32())])
            inner = pa.StructArray.from_arrays([pa.array(v, pa.int32()) for v in values], fields=list(names))
            return pa.ListArray.from_arrays(pa.array(first, pa.int32()), inner)

        return [_lists(found.a.ids, found.a.first), _lists(found.b.ids, found.b.first), pairs(both, cut), pairs(last, ends)]

    ids = T.ArrayType(T.IntegerType())
    places = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())]))
    return _named(_mapped(docs, aligner, keys, text, results, [
        T.StructField("a_ids", ids), T.StructField("b_ids", ids), T.StructField("overlaps", places),
        T.StructField("groups", places)]), keys)


def summaries(docs: DataFrame, aligner: Aligner, keys: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``key0, key1...`` of every row with ``n_a``, ``n_b``, ``n_groups``, the pair number of every link (``links``), and
    the SHA-256 of the printed groups ('' without tokens).  Odd rows as in ``aligned``."""

    def results(own: Aligner, found: Aligned) -> list[pa.Array]:
        cut = np.searchsorted(found.last_a, found.a.first)
        digests = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in own.printed(found)]
        return [pa.array(np.diff(found.a.first)), pa.array(np.diff(found.b.first)), pa.array(np.diff(cut)),
                _lists(own.links(found), cut), pa.array(digests, pa.string())]

    long = T.LongType()
    return _mapped(docs, aligner, keys, text, results, [
        *[T.StructField(c, long) for c in ("n_a", "n_b", "n_groups")],
        T.StructField("links", T.ArrayType(T.IntegerType())), T.StructField("groups_sha256", T.StringType())])


def pair_counts(summary: DataFrame, aligner: Aligner) -> np.ndarray:
    """How many links hold each pair, over all rows: one number for each pair that can be linked."""
    counted = summary.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")).toArrow()
    out = np.zeros(aligner.pairs.size, np.int64)
    out[counted["pair"].to_numpy()] = counted["n"].to_numpy()
    return out


def linked(docs: DataFrame, aligner: Aligner, keys: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ``keys`` of every row with what ``summaries`` has but the links, and with ``n_links``, ``n_best`` (links whose pair is the most frequent one of its
    B token over all rows, ties included) and ``count_sum`` (the sum of the links' pair counts).

    The texts are encoded once: the links are a table in the shared folder of ``spark.checkpoint.dir``.  Counts come to the
    driver and go to the tasks as one number per possible pair, a size that the vocabularies bound.
    """
    summary = stage(summaries(docs, aligner, keys, text))
    counts = pair_counts(summary, aligner)
    b_ids = aligner.pairs.b_ids(aligner.a, aligner.b)
    most = np.zeros(len(aligner.b.texts), np.int64)
    np.maximum.at(most, b_ids[b_ids >= 0], counts[b_ids >= 0])
    shared = shipped(docs.sparkSession, (counts, (b_ids >= 0) & (counts == most[b_ids])))
    plain = [c for c in summary.columns if c != "links"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, best = shared.value
        for batch in batches:
            links = batch.column("links")
            pairs, first = links.values.to_numpy(), links.offsets.to_numpy()
            total = np.r_[0, np.cumsum(table[pairs])]
            top = np.r_[0, np.cumsum(best[pairs], dtype=np.int64)]
            added = [np.diff(first).astype(np.int64), top[first[1:]] - top[first[:-1]], total[first[1:]] - total[first[:-1]]]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in plain], *map(pa.array, added)],
                                             names=[f.name for f in schema.fields])

    kinds = {f.name: f for f in summary.schema.fields}
    schema = T.StructType([*[kinds[c] for c in plain], *[T.StructField(c, T.LongType()) for c in ("n_links", "n_best", "count_sum")]])
    return _named(summary.mapInArrow(weigh, schema), keys)
