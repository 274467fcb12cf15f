import hashlib
from collections import Counter

import pyarrow as pa
import pytest
import sentencepiece
import tokenizers

from gridcast.llm import alignment
from gridcast.llm.common import table
from gridcast.llm.queries import BYTE_LEVEL, PIECE_MODEL, QUERIES

ODD = [(1, None), (2, ""), (3, " "), (4, "  two  spaces "), (5, "a"), (6, "tab\t x\n y  \n\n z"), (7, "▁ mark"),
       (8, "a <|endoftext|> b </s> <s>"), (9, "z\U0001F600 ß  x　 y 中文"), (9, "z\U0001F600 ß  x　 y 中文"),
       (None, "no key"), (10, "don't we'll  I'M"), (11, "word " * 3000), (12, "\x00\x1c \x1f a"), (13, "l" * 5000)]


@pytest.fixture(scope="module")
def aligner():
    return alignment.load(BYTE_LEVEL, PIECE_MODEL)


@pytest.fixture(scope="module")
def plainly():
    """Ids and byte strings of both sides by the two libraries, the text as a whole."""
    a = tokenizers.Tokenizer.from_file(BYTE_LEVEL)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    letters = alignment.byte_level_letters()

    def encode(text):
        if not text:
            return [], []
        left = [(k, bytes(letters[c] for c in a.id_to_token(k))) for k in a.encode(" " + text, add_special_tokens=False).ids]
        right = [(k, bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode())
                 for k in b.encode(text)]
        whole = (" " + text).encode()
        same = b"".join(t for _, t in left) == whole and b"".join(t for _, t in right) == whole
        return (left, right) if same else ([], [])

    return encode


def ranges(tokens):
    end, out = 0, []
    for k, text in tokens:
        out.append((k, end, end + len(text)))
        end += len(text)
    return out


def expected(rows, encode):
    """Every column of the query, from all pairs of tokens of each document."""
    docs, counts = [], Counter()
    for key, text in rows:
        a, b = map(ranges, encode(text))
        ends = {e: k for k, _, e in a}
        links = [(ends[e], k) for k, _, e in b if e in ends]
        counts.update(links)
        groups, i, j = [], 0, 0
        for e in sorted({e for _, _, e in a} & {e for _, _, e in b}):
            n, m = i, j
            while n < len(a) and a[n][2] <= e:
                n += 1
            while m < len(b) and b[m][2] <= e:
                m += 1
            groups.append("|".join(",".join(str(k) for k, _, _ in part) for part in (a[i:n], b[j:m])))
            i, j = n, m
        docs.append((key, len(a), len(b), groups, links))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted(((key, n_a, n_b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
                   for key, n_a, n_b, groups, links in docs), key=str)


def test_whole_query_against_all_pairs(spark, small, plainly):
    rows = [(r.doc_id, r.text) for r in table(spark, small, "documents").collect()]
    assert sorted((tuple(r) for r in QUERIES["op13_tokenizer_alignment"](spark, small).collect()), key=str) == expected(rows, plainly)


def test_odd_rows(spark, docs_of, aligner, plainly):
    found = alignment.linked(docs_of(ODD), aligner).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    got = sorted((tuple(r) for r in found.collect()), key=str)
    assert got == expected(ODD, plainly)
    by_key = {r[0]: r for r in got}
    for key in (1, 2, 7):
        assert by_key[key][1:] == (0, 0, 0, 0, 0, 0, "")
    assert by_key[8][1] > 0  # special strings are plain text
    assert alignment.linked(docs_of([]), aligner).count() == 0


def test_clashing_names(spark, docs_of, aligner):
    odd = docs_of([(1, "some text"), (2, None)]).selectExpr(
        "doc_id AS links", "text AS `__text`", "text AS n_a", "1 AS pair", "2 AS `a.b`")
    rows = alignment.aligned(odd, aligner, ("links", "a.b"), "__text").orderBy("links").collect()
    assert [(r["links"], r["a.b"], len(r["a_ids"]) > 0) for r in rows] == [(1, 2, True), (2, 2, False)]


def test_overlaps_and_groups(spark, docs_of, aligner, plainly):
    texts = dict((k, t) for k, t in ODD if t is None or len(t) < 200)
    found = alignment.aligned(docs_of(list(texts.items())), aligner).collect()
    assert len(found) == len(texts)
    for row in found:
        a, b = map(ranges, plainly(texts[row.doc_id]))
        assert row.a_ids == [k for k, _, _ in a] and row.b_ids == [k for k, _, _ in b]
        both = [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[1] < y[2] and y[1] < x[2]]
        assert [(o.a, o.b) for o in row.overlaps] == both
        assert [(g.a, g.b) for g in row.groups] == [(i, j) for i, j in both if a[i][2] == b[j][2]]


def test_pair_numbers_tell_pairs_apart(aligner):
    b_ids = aligner.pairs.b_ids(aligner.a, aligner.b)
    seen = {}
    text = " the quick brown fox\nß中 \x07 don't A B C 12345 %%% ### naïve".strip()
    found = aligner.aligned(pa.array([text, text[::-1]]))
    for a, b, number in zip(found.a.ids[found.last_a].tolist(), found.b.ids[found.last_b].tolist(),
                            aligner.links(found).tolist(), strict=True):
        assert seen.setdefault(number, (a, b)) == (a, b) and b_ids[number] == b
    assert len(set(seen.values())) == len(seen) and max(seen) < aligner.pairs.size
    assert aligner.pairs.size == 2 * sum(map(len, aligner.a.texts)) + 2 * sum(map(len, aligner.b.texts))


def test_words_kept_and_forgotten(aligner, monkeypatch):
    texts = pa.array([f"word{k} other{k}, end." for k in range(300)])
    whole = list(aligner.printed(aligner.aligned(texts)))
    monkeypatch.setattr(alignment, "KEPT", 10)
    again = [x for k in range(0, 300, 50) for x in aligner.printed(aligner.aligned(texts.slice(k, 50)))]
    assert again == whole


def test_the_slower_library_gives_the_same(aligner):
    texts = [" plain words", " don't  stop\n\n now ", " <|endoftext|>", " ß中\U0001F600 a"]
    slow = alignment.ByteLevel(aligner.a.source)
    slow.ranked = False
    assert aligner.a.ranked and slow.encode(texts) == aligner.a.encode(texts)
