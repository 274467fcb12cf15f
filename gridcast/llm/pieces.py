"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model file is compiled into three parts: the normaliser (the rewriting transducer of the model's character map, white-space
marks, the dummy prefix), the pieces (an automaton that emits the id of every piece that ends at a position) and the byte fallback (a character in no
piece emits its bytes).  Composed with a text they give a lattice, and the encoding is its shortest path in the tropical semiring.

* A unigram model's arcs weigh the negated piece score, an unknown character the lowest score and a penalty.
* A BPE model's arcs weigh zero, and two pieces may follow each other only where merging their joined text would
  leave the seam between them; else the transition weighs infinity.  A path of finite weight is exactly the result of
  the merges: merges of a text that never cross its final seams are those of each adjacent pair on its own, and the
  first merge to cross a seam would cross it in that pair too.  So one path is finite, for every prefix as well, and
  each position needs a single state.

No piece runs over the start of a word (checked when compiled), so words are composed one by one, and their paths
are kept for the next time.  The compiled model is sent to the executors once; each Python worker keeps its paths.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.llm.common import shipped, small_batches, unused

MARK = "▁"
# Fixed values of the model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
UNKNOWN_PENALTY = 10.0
#: Words whose paths a worker keeps (twice as many with those of the generation before), and seams between pieces.
WORDS_KEPT, SEAMS_KEPT, LONGEST_KEPT = 750_000, 500_000, 64
#: Characters whose ids a task holds at a time, but for a single longer text.
CHUNK_CHARS = 1 << 20
INFINITE = float("inf")
#: Nodes of a character map whose children are looked up at a time.
TRIE_NODES = 4096


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value = varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            value = data[at:at + size]
            at += size
        yield tag >> 3, value


@dataclass
class Spec:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)  # text, score, type
    kind: int = UNIGRAM
    byte_fallback: bool = False
    dummy_prefix: bool = True
    squeeze: bool = True
    mark_spaces: bool = True
    rules: bytes = b""


def read_spec(data: bytes) -> Spec:
    spec = Spec()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            spec.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
            spec.kind, spec.byte_fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
        elif number == 3:
            how = dict(_fields(value))
            spec.rules = how.get(2, b"")
            spec.dummy_prefix, spec.squeeze, spec.mark_spaces = (bool(how.get(k, 1)) for k in (3, 4, 5))
    return spec


def read_rules(data: bytes) -> dict[str, str]:
    """The rewrite rules of a compiled character map: from -> to.

    The map is the size of a trie in bytes, the trie, and all results, each ended by a zero byte.  The trie is an array of
    32-bit units: a node's children lie at its own place, xor its offset, xor the next byte, and repeat that byte; a node
    with a value has it in the unit at its offset, as the place of the result.
    """
    if len(data) < 8:
        raise ValueError("not a compiled character map")
    size = struct.unpack_from("<I", data)[0]
    if size % 4 or not 0 < size <= len(data) - 4:
        raise ValueError("not a compiled character map")
    units, results, rules = np.frombuffer(data, "<u4", size // 4, 4), data[4 + size:], {}
    letters = np.arange(1, 256, dtype=np.uint32)
    todo = [(np.zeros(1, np.uint32), [b""])]  # nodes and the bytes that lead to them
    while todo:
        nodes, paths = todo.pop()
        own = units[nodes]
        base = nodes ^ ((own >> 10) << ((own & 512) >> 6))
        for at in np.flatnonzero((own & 256) > 0).tolist():
            start = int(units[base[at]]) & 0x7FFFFFFF
            if paths[at]:
                rules[paths[at].decode()] = results[start:results.index(0, start)].decode()
        children = base[:, None] ^ letters
        there = units[np.minimum(children, len(units) - 1)] & 0x800000FF == letters
        rows, columns = np.nonzero(there & (children < len(units)))
        below = [paths[r] + bytes([c + 1]) for r, c in zip(rows.tolist(), columns.tolist(), strict=True)]
        found = children[rows, columns]
        todo += [(found[k:k + TRIE_NODES], below[k:k + TRIE_NODES]) for k in range(0, len(found), TRIE_NODES)]
    return rules


class Rewriter:
    """A transducer that goes through a text once: where rules start it takes the longest one, else it copies a character.

    ``kept`` texts (user-defined pieces) are copied as they are, before any rule.  States are the beginnings of rules; a
    pattern finds the places where a state is left at all, so plain stretches are copied at once.
    """

    def __init__(self, rules: dict[str, str], kept: list[str]):
        none: dict[str, int] = {}  # of all states at the end of rules
        self.states: list[dict[str, int]] = [{}]
        self.results: list[str | None] = [None]
        for text, result in rules.items():
            state = 0
            for char in text:
                if char not in self.states[state]:
                    if self.states[state] is none:
                        self.states[state] = {}
                    self.states[state][char] = len(self.states)
                    self.states.append(none)
                    self.results.append(None)
                state = self.states[state][char]
            self.results[state] = result
        alone = {t for t in rules if len(t) == 1}
        first, second = {t[0] for t in rules if len(t) > 1}, {t[1] for t in rules if len(t) > 1}
        ways = [f"({'|'.join(map(re.escape, sorted(kept, key=len, reverse=True))) or '(?!)'})"]
        ways += [_any_of(alone)] if alone else []
        ways += [f"{_any_of(first)}(?={_any_of(second)})"] if first else []
        self.starts = re.compile("|".join(ways), re.DOTALL)

    def __call__(self, text: str) -> str:
        out, done = [], 0
        match = self.starts.search(text)
        while match:
            at = match.start()
            out.append(text[done:at])
            done = at + 1
            result = text[at]
            if match.group(1):
                done, result = match.end(), match.group(1)
            else:
                state, end = self.states[0].get(text[at]), at + 1
                while state is not None:
                    if self.results[state] is not None:
                        done, result = end, self.results[state]
                    state = self.states[state].get(text[end]) if end < len(text) else None
                    end += 1
            out.append(result)
            match = self.starts.search(text, done)
        return "".join(out) + text[done:]


def _any_of(chars: set[str]) -> str:
    return f"[{''.join(map(re.escape, sorted(chars)))}]"


class Transducer:
    """The compiled normaliser, pieces and byte fallback of one model."""

    def __init__(self, spec: Spec):
        users = [p[0] for p in spec.pieces if p[2] == USER]
        self.rewritten = Rewriter(read_rules(spec.rules), users) if spec.rules else None
        if spec.kind not in (UNIGRAM, BPE) or not spec.mark_spaces:
            raise ValueError("unigram and BPE models with white-space marks are supported")
        self.spec, self.bpe = spec, spec.kind == BPE
        self.texts = [p[0] for p in spec.pieces]
        self.unknown = next((k for k, p in enumerate(spec.pieces) if p[2] == UNKNOWN), 0)
        self.byte_ids = {int(p[0][3:5], 16): k for k, p in enumerate(spec.pieces) if p[2] == BYTE}
        self.byte_of = {k: b for b, k in self.byte_ids.items()}
        self.silent = {k for k, p in enumerate(spec.pieces) if p[2] in (CONTROL, UNKNOWN)}
        # what an id says by itself: a byte of ASCII is a character whatever its neighbours are, other bytes need them
        self.spoken = ["" if k in self.silent else chr(b) if (b := self.byte_of.get(k, 128)) < 128 else t for k, t in enumerate(self.texts)]
        self.partial = np.array([self.byte_of.get(k, 0) > 127 for k in range(len(self.texts))], bool)
        self.scores = {p[0]: p[1] for p in spec.pieces if p[2] in (NORMAL, USER)}
        self.by_words = not any(MARK in text.lstrip(MARK) for text in self.scores)
        self.weights = [-p[1] for p in spec.pieces]
        self.unknown_weight = UNKNOWN_PENALTY - min(self.scores.values(), default=0.0)
        self.words: dict[str, bytes] = {}  # ids of words, as 32-bit numbers side by side
        self.older: dict[str, bytes] = {}
        self.seams: dict[int, dict[int, bool]] = {}  # left piece, right piece
        self.seams_kept = 0
        self.inner = {pair for text in self.scores for pair in zip(text, text[1:], strict=False)}
        # characters that stand beside no other in any piece, like line ends, are words of their own; without the byte
        # fallback, neighbouring unknown ones are to be one
        joined = {char for pair in self.inner for char in pair}
        alone = {c for c in map(chr, range(128)) if c not in joined} if spec.byte_fallback else set()
        self.cut = re.compile(f"{MARK}*[^{MARK}{''.join(map(re.escape, sorted(alone)))}]+|{MARK}+" + (f"|{_any_of(alone)}+" if alone else ""))
        whole = {p[0]: k for k, p in enumerate(spec.pieces)
                 if p[2] in (NORMAL, USER) and p[0] and (not self.bpe or len(self._merged(p[0])) == 1)}
        self.arcs = ahocorasick.Automaton()  # emits (piece, length) at the end of every occurrence of every piece
        for text, k in whole.items():
            self.arcs.add_word(text, (k, len(text)))
        self.arcs.make_automaton()

    # -- normaliser -----------------------------------------------------------

    def normalised(self, text: str) -> str:
        if self.rewritten is not None:
            text = self.rewritten(text)
        if self.spec.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        line = (MARK if self.spec.dummy_prefix else "") + text.replace(" ", MARK)
        return line.rstrip(MARK) if self.spec.squeeze else line

    def plain(self, text: str) -> str:
        """What decoding gives: the normalised text with spaces, without the dummy prefix."""
        text = text.replace(MARK, " ")
        return text[1:] if self.spec.dummy_prefix and text.startswith(" ") else text

    # -- weights of a BPE model -------------------------------------------------

    def _merged(self, text: str, seam: int = 0) -> list[str]:
        """Merge the best-scored neighbours, leftmost first, until none is a piece; [] once a merge crosses ``seam``."""
        parts, scores = list(text), self.scores
        offers = [scores.get(a + b, -INFINITE) for a, b in zip(parts, parts[1:], strict=False)]
        while offers:
            best = max(offers)
            if best == -INFINITE:
                break
            at = offers.index(best)
            if seam:
                start = sum(map(len, parts[:at]))
                if start < seam < start + len(parts[at]) + len(parts[at + 1]):
                    return []
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del offers[at]
            if at > 0:
                offers[at - 1] = scores.get(parts[at - 1] + parts[at], -INFINITE)
            if at < len(offers):
                offers[at] = scores.get(parts[at] + parts[at + 1], -INFINITE)
        return parts

    def _text(self, label: int) -> str:
        return self.texts[label] if label >= 0 else chr(-1 - label)

    def seam_holds(self, left: int, right: int) -> bool:
        a = self._text(left)
        return bool(self._merged(a + self._text(right), len(a)))

    def _new_seam(self, left: int, right: int) -> bool:
        self.seams_kept += 1
        if self.seams_kept > SEAMS_KEPT:
            for known in self.seams.values():
                known.clear()
            self.seams_kept = 1
        return self.seam_holds(left, right)

    # -- shortest path ----------------------------------------------------------

    def shortest_path(self, word: str) -> list[int]:
        """Labels of the best path over one normalised word: piece ids, or -1 - code point of an unknown character."""
        return self._by_seams(word) if self.bpe else self._by_weights(word)

    def _by_seams(self, word: str) -> list[int]:
        """All weights are zero or infinite, so a position is done once a finite path reaches it."""
        size, seams = len(word), self.seams
        last: list[int | None] = [None] * (size + 1)
        before = [0] * (size + 1)
        for at, (label, long) in self.arcs.iter(word):
            at += 1
            if last[at] is not None:
                continue
            start = at - long
            if start:
                left = last[start]
                if left is None:
                    self._unknown_until(start, word, last, before)
                    left = last[start]
                known = seams.get(left)
                if known is None:
                    known = seams[left] = {}
                holds = known.get(label)
                if holds is None:
                    holds = known[label] = self._new_seam(left, label)
                if not holds:
                    continue
            last[at], before[at] = label, start
        if size and last[size] is None:
            self._unknown_until(size, word, last, before)
        return self._traced(last, before)

    @staticmethod
    def _unknown_until(end: int, word: str, last: list, before: list[int]) -> None:
        """Where no piece ends a finite path, the character before is an arc of its own."""
        start = end
        while start and last[start] is None:
            start -= 1
        for at in range(start + 1, end + 1):
            last[at], before[at] = -1 - ord(word[at - 1]), at - 1

    def _by_weights(self, word: str) -> list[int]:
        """Least sum of weights; the first found of equal ones."""
        size = len(word)
        cost, last, before = [0.0] + [INFINITE] * size, [None] * (size + 1), [0] * (size + 1)
        ends: dict[int, list[tuple[int, int]]] = {}
        for end, (label, long) in self.arcs.iter(word):
            ends.setdefault(end + 1, []).append((long, label))
        for end in range(1, size + 1):
            arcs = sorted(ends.get(end, ()), reverse=True)
            for long, label in arcs:
                if cost[end - long] + self.weights[label] < cost[end]:
                    cost[end], last[end], before[end] = cost[end - long] + self.weights[label], label, end - long
            if not any(long == 1 for long, _ in arcs) and cost[end - 1] + self.unknown_weight < cost[end]:
                cost[end], last[end], before[end] = cost[end - 1] + self.unknown_weight, -1 - ord(word[end - 1]), end - 1
        return self._traced(last, before)

    @staticmethod
    def _traced(last: list, before: list[int]) -> list[int]:
        path, end = [], len(last) - 1
        while end > 0:
            path.append(last[end])
            end = before[end]
        return path[::-1]

    def _emitted(self, path: list[int]) -> bytes:
        """Ids of a path: unknown characters go through the byte fallback."""
        if min(path, default=0) >= 0:
            return array("i", path).tobytes()
        out: list[int] = []
        for label in path:
            if label >= 0:
                out.append(label)
            elif self.spec.byte_fallback:
                out += [self.byte_ids[b] for b in chr(-1 - label).encode("utf-8", "surrogatepass")]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)  # neighbouring unknown characters are one
        return array("i", out).tobytes()

    # -- texts --------------------------------------------------------------------

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; none for a null or empty one."""
        line = self.normalised(text or "")
        if not self.by_words:
            return np.frombuffer(self._emitted(self.shortest_path(line)), np.int32)
        # a word is its marks and what follows up to the next mark, or to a character that no piece joins to others
        words = self.cut.findall(line)
        found = list(map(self.words.get, words))
        for at in [at for at, ids in enumerate(found) if ids is None]:
            found[at] = self._known(words[at])
        return np.frombuffer(b"".join(found), np.int32)

    def _known(self, word: str) -> bytes:
        """Ids of a word, or a stretch of one: kept ones, else those found now."""
        ids = self.words.get(word)
        if ids is None:
            ids = self.older.get(word)
            ids = self._remembered(word, self._composed(word) if ids is None else ids)
        return ids

    def _composed(self, word: str) -> bytes:
        """Ids of a word that is not kept.  Between two characters that stand together in no piece there is always
        a seam: the stretches between such seams, like a stem and its punctuation, are composed and kept each."""
        inner, seams = self.inner, []
        for at, pair in enumerate(zip(word, word[1:], strict=False), 1):
            if pair not in inner:
                seams.append(at)
        if not seams:
            return self._emitted(self.shortest_path(word))
        found = [self._known(word[a:b]) for a, b in zip([0, *seams], [*seams, len(word)], strict=True)]
        if not self.spec.byte_fallback and any(self.unknown in array("i", ids) for ids in found):
            return self._emitted(self.shortest_path(word))  # neighbouring unknown characters are one
        return b"".join(found)

    def _remembered(self, word: str, ids: bytes) -> bytes:
        if len(word) <= LONGEST_KEPT:
            if len(self.words) >= WORDS_KEPT:
                self.words, self.older = {}, self.words
            self.words[word] = ids
        return ids

    def decode(self, ids) -> str:
        """The text of ids; bytes that are not UTF-8 become replacement characters, control ids are silent."""
        spoken, byte_of = self.spoken, self.byte_of
        ids = np.asarray(ids, np.int32)
        partial = np.flatnonzero(self.partial[ids]).tolist()
        ids = ids.tolist()
        out, raw, done = [], bytearray(), 0
        for at in partial:
            if at > done:
                out += [raw.decode("utf-8", "replace"), *map(spoken.__getitem__, ids[done:at])]
                raw = bytearray()
            raw.append(byte_of[ids[at]])
            done = at + 1
        out += [raw.decode("utf-8", "replace"), *map(spoken.__getitem__, ids[done:])]
        return self.plain("".join(out))


def load(path: str) -> Transducer:
    """Compile the model file at ``path`` (on the driver; executors get it by broadcast)."""
    with open(path, "rb") as file:
        return Transducer(read_spec(file.read()))


def _chunks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Stretches of neighbouring rows with about ``CHUNK_CHARS`` characters each, one row at least."""
    start = held = 0
    for end, size in enumerate(sizes, 1):
        held += size
        if held >= CHUNK_CHARS:
            yield start, end
            start, held = end, 0
    if start < len(sizes):
        yield start, len(sizes)


def encoded(docs: DataFrame, model: Transducer, keys: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ``keys`` of every row with its ids, and ``round_trip``: whether decoding gives the text back.

    A null text has no ids and goes back to the empty text; one with the mark U+2581 itself comes back with a space.
    Repeated rows each get a result; an empty table gives an empty one; further columns are not read.
    """
    shared = shipped(docs.sparkSession, model)
    given = unused(keys, "__text")
    rows = small_batches(docs).select(*keys, F.col(f"`{text}`").alias(given))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        transducer = shared.value
        for batch in batches:
            texts = [x if x is not None else "" for x in batch.pop(given)]
            for start, end in _chunks([len(x) for x in texts]):
                ids = [transducer.encode(x) for x in texts[start:end]]
                back = [transducer.decode(k) == x for k, x in zip(ids, texts[start:end], strict=True)]
                yield batch.iloc[start:end].assign(ids=ids, round_trip=back)

    fields = [f for f in rows.schema.fields if f.name != given]
    return rows.mapInPandas(encode, T.StructType([
        *fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())]))


def decoded(rows: DataFrame, model: Transducer, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids in the column ``into`` in front; null ids give an empty text."""
    shared = shipped(rows.sparkSession, model)

    @F.pandas_udf(T.StringType())
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([shared.value.decode(x if x is not None else []) for x in batch], dtype=object)

    return small_batches(rows).select(decode(F.col(ids)).alias(into), *[F.col(f"`{c}`") for c in rows.columns])
