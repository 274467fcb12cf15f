import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from gridcast.llm import fingerprints
from gridcast.llm.common import table
from gridcast.llm.queries import QUERIES

COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
           "edited_in_text", "n_shingles"]
ODD = [(3, None), (2, ""), (1, "one"), (7, " \t\n"), (None, "no key here"), (None, None), (5, "a b c d e f g h"),
       (5, "a b c d e f g h"), (5, "ß中\U0001F600 Übung MIX mix  end"), (2 ** 63 - 1, "largest"), (-2 ** 63, "smallest"),
       (6, " ".join(f"w{k % 3001}" for k in range(20_000)))]


def signed(x):
    return x - 2 ** 64 if x >= 2 ** 63 else x


def sketch(text, k):
    table = {chr(c): chr(c + 32) for c in range(65, 91)}
    words = "".join(table.get(c, c) for c in text)
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [" ".join(words)] if words else []
    return sorted({signed(xxhash.xxh64(s.encode(), seed=42).intdigest()) for s in shingles})[:k]


def shares(a, b, k):
    """Resemblance, and containment of a in b."""
    limit = min(x[-1] if len(x) == k else 2 ** 63 - 1 for x in (a, b))
    x, y = {h for h in a if h <= limit}, {h for h in b if h <= limit}
    return len(x & y) / len(x | y) if x | y else 1.0, len(x & y) / len(x) if x else 1.0


def printed(a):
    return "".join(f"{h % 2 ** 64:016x}" for h in a)


def expected(rows, k=fingerprints.K):
    rows = [(key, text or "") for key, text in rows]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), signed(xxhash.xxh64(r[1].encode(), seed=42).intdigest())))
    out = []
    for i, (key, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        a, e, b = sketch(text, k), sketch(edited, k), sketch(following, k)
        count = float(len(a)) if len(a) < k else (k - 1) / ((float(a[-1]) + 2.0 ** 63) / 2.0 ** 64)
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), printed(a), printed(e), shares(a, e, k)[0],
                    shares(a, b, k)[0], shares(e, a, k)[1], count))
    return sorted(out, key=str)


def got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_query(spark, small):
    rows = [(r.doc_id, r.text) for r in table(spark, small, "documents").collect()]
    assert got(QUERIES["op12_document_fingerprints"](spark, small)) == expected(rows)


@pytest.mark.parametrize("range_rows", [1, 2, 5, 1000])
def test_odd_rows_over_many_ranges(spark, docs_of, range_rows):
    assert got(fingerprints.fingerprinted(docs_of(ODD).repartition(3), k=16, range_rows=range_rows)) == expected(ODD, 16)


def test_empty_and_single(spark, docs_of):
    assert got(fingerprints.fingerprinted(docs_of([]))) == []
    assert got(fingerprints.fingerprinted(docs_of([(1, "abc def")]))) == expected([(1, "abc def")])


def test_a_third_of_the_rows_equal(spark, docs_of, monkeypatch):
    monkeypatch.setattr(fingerprints, "COPIES", 7)
    rows = [(k, f"text {k} of some length") for k in range(60)] + [(30, "the same again and again")] * 40 + [(None, "x")] * 30
    found = fingerprints.fingerprinted(docs_of(rows).repartition(4), range_rows=10)
    assert got(found) == expected(rows)
    pairs, many = fingerprints.with_next(docs_of(rows), range_rows=10)
    assert many and pairs.count() == 62 and pairs.agg(F.sum("copies")).first()[0] == len(rows)


def test_a_key_with_many_texts_is_spread(spark, docs_of):
    rows = [(7, f"text {k}") for k in range(300)] + [(k, f"other {k}") for k in range(100, 200)]
    pairs, many = fingerprints.with_next(docs_of(rows), range_rows=20)
    assert not many
    assert got(fingerprints.fingerprinted(docs_of(rows), range_rows=20)) == expected(rows)
    keys = docs_of(rows).select("doc_id", F.xxhash64("text").alias("h"))
    ranges = fingerprints.find_ranges(keys, ["doc_id", "h"], 20)
    sizes = ranges.number(keys.withColumn("key", F.struct("doc_id", "h")), "key", "at").groupBy("at").count().collect()
    assert len(sizes) >= 15 and max(r["count"] for r in sizes) < 100


def test_parts_merge_to_the_whole(spark):
    draw = random.Random(3)
    words = [f"w{draw.randrange(4000)}" for _ in range(3000)]
    # parts overlap by a shingle less a word
    parts = [(1, " ".join(words[a:a + 504])) for a in range(0, 3000, 500)] + [(2, "short"), (3, ""), (4, ""), (4, "a b")]
    rows = fingerprints.with_sketch(spark.createDataFrame(parts, "`a.b` int, text string"), F.col("text"), "sketch", k=64)
    whole = {r["a.b"]: r["sketch"] for r in fingerprints.merge_parts(rows, ["a.b"], "sketch", 64).collect()}
    assert whole == {1: sketch(" ".join(words), 64), 2: sketch("short", 64), 3: [], 4: sketch("a b", 64)}
    pair = spark.createDataFrame([(sketch(parts[0][1], 64), sketch(parts[1][1], 64))], "a array<bigint>, b array<bigint>")
    assert pair.select(fingerprints.merged(F.col("a"), F.col("b"), 64)).first()[0] == sketch(" ".join(words[:1004]), 64)


def test_estimates_are_near_the_truth(spark):
    draw = random.Random(4)
    a = [f"a{draw.randrange(10 ** 9)}" for _ in range(6000)]
    b = a[:4000] + [f"b{draw.randrange(10 ** 9)}" for _ in range(4000)]
    rows = spark.createDataFrame([(" ".join(a), " ".join(b))], "x string, y string")
    both = fingerprints.with_sketch(fingerprints.with_sketch(rows, F.col("x"), "p", k=512), F.col("y"), "q", k=512)
    p, q = F.col("p"), F.col("q")
    like, part, back, count = both.select(
        fingerprints.resemblance(p, q, 512), fingerprints.containment(p, q, 512), fingerprints.containment(q, p, 512),
        fingerprints.shingle_count(q, 512)).first()
    assert abs(like - 0.4) < 0.07 and abs(part - 2 / 3) < 0.1 and abs(back - 0.5) < 0.08 and abs(count / 8000 - 1) < 0.15


def test_no_python_and_one_shuffle_of_texts(spark, small):
    plan = QUERIES["op12_document_fingerprints"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
