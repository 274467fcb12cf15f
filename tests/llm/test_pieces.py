"""Ids against the public library, exact round trips, the unigram semiring by brute force."""

import random
import struct

import pytest
import sentencepiece

from gridcast.llm import pieces, queries

MODEL = queries.PIECE_MODEL


@pytest.fixture(scope="module")
def model():
    return pieces.load(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


ODD = ["", " ", "  a  b ", "▁x", "日本語のテキスト。漢字", "😀 emoji 𝔘𝔫𝔦", "a\u0000b\tc\n\n  d", "=" * 300, "<s> </s> <0x41> <unk>",
       "مرحبا", "ﬁ é é", " " * 50, "\U0010ffff", "Hello World", "x" * 100, "𝔘" * 3000, "𝔘x" * 500]


def test_ids_of_odd_texts(model, library):
    rng = random.Random(1)
    letters = "ab cdeéß▁ \n日本0=" + "xyzt"
    for text in ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(2000)]:
        ids = model.encode(text).tolist()
        assert ids == library.encode(text), text
        assert model.decode(ids) == library.decode(ids) == text.replace("▁", " ")


def test_ids_of_whole_tables(spark, small, model, library):
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    texts += [r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()]
    for text in texts:
        ids = model.encode(text).tolist()
        assert ids == library.encode(text) and model.decode(ids) == text


def test_kept_words_change_nothing(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "WORDS_KEPT", 3)
    monkeypatch.setattr(pieces, "SEAMS_KEPT", 5)
    text = " ".join(random.Random(7).choice(["other", "words", "again", "naïve", "schön", "été"]) for _ in range(300))
    assert model.encode(text).tolist() == library.encode(text)


def test_kept_words_end_at_characters_that_no_piece_joins(library):
    """Line ends and digits would make every word of a text a new one."""
    model = pieces.load(MODEL)
    text = "one two\n\nthree\tone 1999two2000\nthree 7\n"
    assert model.encode(text).tolist() == library.encode(text) and model.decode(model.encode(text)) == text
    assert {"three", "▁one", "\n\n", "two"} <= set(model.words)
    assert not [w for w in model.words if any(c.isalpha() for c in w) and set(w) & set("\n\t0123456789")]


def test_forgotten_words_are_not_composed_again(library, monkeypatch):
    monkeypatch.setattr(pieces, "WORDS_KEPT", 40)
    model, composed = pieces.load(MODEL), []
    own = model._composed
    model._composed = lambda word: composed.append(word) or own(word)
    words = [f"thtiing{a}." for a in "abcdefghij"]
    for _ in range(9):
        text = " ".join(words)
        assert model.encode(text).tolist() == library.encode(text)
        model.encode("other " * 3)
    model.words, model.older = {}, model.words
    composed.clear()
    assert model.encode(" ".join(words)).tolist() == library.encode(" ".join(words)) and not composed


def test_any_ids_decode(model):
    """Bytes in any order, silent ids between them: as one id after the other would say."""
    rng = random.Random(2)
    some = [*model.byte_ids.values(), 0, 1, 2, *range(259, 400)]
    for _ in range(500):
        ids, out, raw = [rng.choice(some) for _ in range(rng.randint(0, 12))], "", b""
        for k in ids:
            if k in model.byte_of:
                raw += bytes([model.byte_of[k]])
                continue
            out, raw = out + raw.decode("utf-8", "replace") + ("" if k in model.silent else model.texts[k]), b""
        assert model.decode(ids) == model.plain(out + raw.decode("utf-8", "replace"))


@pytest.mark.parametrize("sizes", [[], [0], [5], [3, 3, 3], [10, 1, 1, 10, 0]])
def test_chunks_hold_every_row(monkeypatch, sizes):
    monkeypatch.setattr(pieces, "CHUNK_CHARS", 5)
    spans = list(pieces._chunks(sizes))
    assert [i for a, b in spans for i in range(a, b)] == list(range(len(sizes))) and all(a < b for a, b in spans)


def test_unknown_bytes_decode(model):
    assert model.decode([model.byte_ids[0xFF], 1, 2, 0]) == "�"


def unigram(texts, **how):
    spec = pieces.Spec(kind=pieces.UNIGRAM, squeeze=False, **how)
    spec.pieces = [("<unk>", 0.0, pieces.UNKNOWN)] + [(t, s, pieces.NORMAL) for t, s in texts]
    if spec.byte_fallback:
        spec.pieces += [(f"<0x{b:02X}>", 0.0, pieces.BYTE) for b in range(256)]
    return pieces.Transducer(spec)


def test_unigram_shortest_path():
    scores = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.0, "▁a": -2.2, "ba": -4.0, "aba": -5.0, "bb": -9.0}
    model = unigram(scores.items())

    def best(word):
        if not word:
            return 0.0
        own = [best(word[n:]) - scores[word[:n]] for n in range(1, len(word) + 1) if word[:n] in scores]
        return min([*own, best(word[1:]) + 10 + 9.0] if word[0] not in scores else own)

    rng = random.Random(4)
    for _ in range(300):
        word = "▁" + "".join(rng.choice("aabbz") for _ in range(rng.randint(0, 8)))
        path = model.shortest_path(word)
        assert "".join(model._text(k) for k in path) == word
        weight = sum(model.weights[k] if k >= 0 else model.unknown_weight for k in path)
        assert abs(weight - best(word)) < 1e-9


def test_unknown_characters():
    plain, bytewise = unigram([("▁", -1.0), ("a", -1.0)]), unigram([("▁", -1.0), ("a", -1.0)], byte_fallback=True)
    assert plain.encode("azza").tolist() == [1, 2, 0, 2]
    assert bytewise.decode(bytewise.encode("a é 日").tolist()) == "a é 日"


def message(*fields):
    """A protocol-buffer message of (number, value): whole numbers, floats, bytes."""
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    out = b""
    for number, value in fields:
        if isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, bytes):
            out += varint(number << 3 | 2) + varint(len(value)) + value
        else:
            out += varint(number << 3) + varint(value)
    return out


def character_map():
    """The published map of the library's own normaliser."""
    normaliser = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    return pieces.read_spec(normaliser.serialized_model_proto()).rules


def unigram_file(words, rules, fallback, squeeze=1, users=()):
    """A unigram model over given words, with weights that floats add up exactly."""
    rng = random.Random(8)
    found = sorted({w[:n] for w in words for n in range(1, len(w) + 1)} | {"▁"} | set("abcdefghijklmnopqrstuvwxyz"))
    own = [(t, -float(rng.randint(64, 900)) / 64, pieces.NORMAL) for t in found]
    own = [("<unk>", 0.0, pieces.UNKNOWN), ("<s>", 0.0, pieces.CONTROL), ("</s>", 0.0, pieces.CONTROL)] + own
    own += [(u, 0.0, pieces.USER) for u in users]
    own += [(f"<0x{b:02X}>", 0.0, pieces.BYTE) for b in range(256)] if fallback else []
    return message(*[(1, message((1, t.encode()), (2, s), (3, kind))) for t, s, kind in own],
                   (2, message((3, pieces.UNIGRAM), (35, fallback))), (3, message((2, rules), (3, 1), (4, squeeze), (5, 1))))


REWRITTEN = ["ﬁ ①  Ａ\tx", "  e\u0301 a\u0300\u0301 q\u0323\u0307 ", "ｶﾞｷﾞ ｶ ﾞ", "\u00a8x \u2003y\u3000z", "\u200bab\ufeff c\r\nd", "㌔ ㍿ ﷺ",
             "한 \u1112\u1161\u11ab", "\x00\x07 \x7f", "▁ a ▁", "①" * 300, "\u0301", "a\u0301" * 200, "ΐ \u03b9\u0308\u0301", "…‥ ½ ²", "\u00ad"]


def test_character_map_rewrites_as_the_library_does():
    rules = pieces.read_rules(character_map())
    normaliser = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", remove_extra_whitespaces=False, add_dummy_prefix=False, escape_whitespaces=False)
    assert len(rules) > 5000 and rules["ﬁ"] == "fi"
    rewritten, rng = pieces.Rewriter(rules, []), random.Random(3)
    some = list(rules)
    texts = REWRITTEN + some + ["".join(rng.choice(rng.choice([some, "ab é\u0301"])) for _ in range(30)) for _ in range(3000)]
    for text in texts:
        assert rewritten(text) == normaliser.Normalize(text), text


def test_rewriter_takes_the_longest_rule():
    rewritten = pieces.Rewriter({"ab": "1", "abcd": "2", "b": "3", "x": ""}, ["abc", "bb"])
    assert rewritten("abcd ab abd bb x cab") == "abcd 1 1d bb  c1"
    assert pieces.Rewriter({"ab": "1", "abcd": "2", "b": "3"}, [])("abcd abce ab b a") == "2 1ce 1 3 a"


@pytest.mark.parametrize("fallback, squeeze", [(0, 1), (1, 1), (1, 0)])
def test_unigram_model_with_a_character_map(spark, fallback, squeeze):
    """Ids of a whole table, and of odd texts, by the tropical path over rewritten text: those of the public library."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    words = sorted({"▁" + w for t in texts[::3] for w in t.split()})[::2]
    data = unigram_file(words, character_map(), fallback, squeeze)
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    model = pieces.Transducer(pieces.read_spec(data))
    for text in [*texts, *ODD, *REWRITTEN]:
        assert model.encode(text).tolist() == library.encode(text), text[:60]


def test_unigram_encoded_by_spark(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    words = sorted({"▁" + w for r in docs.collect() for w in r.text.split()})[::3]
    data = unigram_file(words, character_map(), 1)
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = pieces.encoded(docs, pieces.Transducer(pieces.read_spec(data))).collect()
    assert len(found) == len(texts) and all(r.ids == library.encode(texts[r.doc_id]) for r in found)


def test_unsupported_model():
    with pytest.raises(ValueError):
        pieces.Transducer(pieces.Spec(rules=b"x"))


def test_odd_rows(docs_of, model, library):
    rows = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "é日😀"), (4, "long text " * 200_000), (5, "a▁b")]
    docs = docs_of(rows)
    found = pieces.encoded(docs, model)
    assert found.columns == ["doc_id", "ids", "round_trip"]
    got = sorted((str(r.doc_id), r.ids, r.round_trip) for r in found.collect())
    assert got == sorted((str(k), library.encode(t or ""), k != 5) for k, t in rows)
    back = pieces.decoded(found, model).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in back) == sorted((str(k), (t or "").replace("▁", " ")) for k, t in rows)
    assert pieces.encoded(docs.where("false"), model).collect() == []


def test_query(spark, small, library):
    got = {r.doc_id: r for r in queries.QUERIES["op2_sentencepiece"](spark, small).collect()}
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        assert got[r.doc_id].ids == library.encode(r.text) and got[r.doc_id].round_trip
        assert got[r.doc_id].n_ids == len(got[r.doc_id].ids)
