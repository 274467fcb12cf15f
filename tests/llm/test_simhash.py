"""Fingerprints, BK-trees and groups against brute force."""

import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from gridcast.llm import simhash

ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (6, "ONE Two"), (7, "a b c d"), (8, "a b c d"),
       (9, "É é\x85x \x1c y"), (9, "É é\x85x \x1c y"), (None, "a b c d"), (None, "only without a key"), (None, "only without a key")]


def by_hand(text, length=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i:i + length]) for i in range(len(words) - length + 1)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(values, radius):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def groups_by_hand(rows, radius=2):
    prints = [by_hand(t) for _, t in rows]
    roots = components_by_hand(prints, radius)
    least = {}
    for (key, _), root in zip(rows, roots, strict=True):
        if key is not None:
            least[root] = min(key, least.get(root, key))
    return Counter((key, f"{p:016x}", least.get(r)) for (key, _), p, r in zip(rows, prints, roots, strict=True))


def test_odd_rows(docs_of):
    got = Counter(tuple(r) for r in simhash.groups(docs_of(ODD), 3, 2).collect())
    assert got == groups_by_hand(ODD)


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter(tuple(r) for r in simhash.groups(docs, 3, 2).collect()) == groups_by_hand(rows)


def test_empty_table(docs_of):
    empty = docs_of(ODD).where("false")
    assert simhash.groups(empty, 3, 2).collect() == []
    assert simhash.representatives(empty, 3, 2).collect() == []


def test_long_text_counts_to_its_end(docs_of):
    start = " ".join(f"w{i % 977}" for i in range(150_000))
    rows = [(1, start), (2, start + " tail" * 400_000)]
    got = {r.doc_id: r.fingerprint for r in simhash.groups(docs_of(rows), 3, 2).collect()}
    assert got == {k: f"{by_hand(t):016x}" for k, t in rows} and got[1] != got[2]


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_tree_finds_all_within_radius(radius):
    rng = random.Random(radius)
    values = [rng.getrandbits(64) for _ in range(60)]
    values += [v ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for v in values for _ in range(4)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in values:
        near = tree.within(q, radius)
        assert sorted(near) == [i for i, v in enumerate(values) if (v ^ q).bit_count() <= radius]


@pytest.mark.parametrize("tree_size", [3, 2048])
def test_links_keep_all_components(spark, tree_size):
    """Also where one shard is cut into many trees: a large cloud of near fingerprints, and a long chain."""
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    cloud = {centre ^ (1 << a) ^ (1 << b) for a in range(0, 64, 7) for b in range(64)}
    chain, at = [], rng.getrandbits(64)
    for k in range(40):
        at ^= (1 << (k % 64)) | (1 << ((k * 7 + 3) % 64))
        chain.append(at)
    values = sorted(cloud | set(chain) | {rng.getrandbits(64) for _ in range(100)})
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    edges = simhash.links(spark.createDataFrame(signed, "fp bigint"), 2, tree_size)
    found = {r.node: r.root for r in simhash.components(edges).collect()}
    roots = components_by_hand(values, 2)
    mine = [found.get(s[0], s[0]) for s in signed]
    assert len(set(zip(roots, mine, strict=True))) == len(set(roots)) == len(set(mine))


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    got = simhash.components(spark.createDataFrame(chain + star + [(7, 7)], "a bigint, b bigint"))
    roots = {r.node: r.root for r in got.collect()}
    assert roots == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(200)}


def test_one_row_of_each_group_stays_whole(docs_of):
    docs = docs_of(ODD)
    kept = simhash.representatives(docs, 3, 2)
    assert kept.schema == docs.schema
    named = groups_by_hand(ODD)
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for _, _, c in named if c is not None})
    assert ids.count(None) == 1  # the group without a key keeps one row


def test_one_key_with_different_texts(docs_of):
    """Groups that share their smallest key keep a row each, from their own rows."""
    rng = random.Random(4)
    texts = [" ".join(f"t{k}w{rng.randrange(50)}" for _ in range(30)) for k in range(12)]
    rows = [(9, t) for t in texts] + [(9, texts[0].upper()), (9, texts[1]), (5, texts[2]), (12, texts[3]), (None, texts[4])]
    rows += [(None, "x y z"), (None, "x y  z"), (None, "p q r s"), (9, None), (9, "")]
    roots = components_by_hand([by_hand(t) for _, t in rows], 2)
    signed = lambda t: 42 if t is None else xxhash.xxh64(t.encode(), seed=42).intdigest()
    rank = lambda k, t: (k is None, k or 0, (signed(t) + (1 << 63)) % (1 << 64))
    want = {}
    for row, root in zip(rows, roots, strict=True):
        want[root] = min(want.get(root, row), row, key=lambda r: rank(*r))
    got = simhash.representatives(docs_of(rows), 3, 2).select("doc_id", "text").collect()
    assert Counter(map(tuple, got)) == Counter(want.values()) and len(want) > 12


def test_plan_sends_no_fingerprints_to_all(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plan = simhash.links(simhash.fingerprints(docs, 3, "doc_id", "text").select("fp").distinct(), 2)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in text and "hint" not in text.lower()
    assert plan.agg(F.count("*")).first()[0] >= 0


def test_the_same_row_stays_whatever_the_order(spark):
    rows = [(1, "a b c d", f"source {k}") for k in range(40)] + [(2, "quite another text here", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, rank string")
    kept = {tuple(sorted(map(tuple, simhash.representatives(docs.repartition(n), 3, 2).collect()))) for n in (1, 3, 7)}
    assert len(kept) == 1 and len(next(iter(kept))) == 2


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bands_hold_every_link(radius):
    rng = random.Random(radius)

    def value(band, fp):
        out = 0
        for first, width in band.fixed:
            out = out << width | fp >> first & (1 << width) - 1
        return out

    for band in (simhash.Band([], [(0, 64)]), simhash.Band([], [(0, 64)]).cut(radius)[-1]):
        parts = band.cut(radius)
        for part in parts:
            assert sorted(x for first, width in part.fixed + part.free for x in range(first, first + width)) == list(range(64))
        free = [x for first, width in band.free for x in range(first, first + width)]
        for _ in range(200):
            fp = rng.getrandbits(64)
            other = fp ^ sum(1 << b for b in rng.sample(free, min(radius, len(free))))
            assert any(value(p, fp) == value(p, other) for p in parts)


def test_a_hot_shard_makes_rows_in_step_with_its_values(spark):
    """Thousands of values share 32 bits: cut into trees alone they would make one row for each tree."""
    rng = random.Random(8)
    values = sorted({rng.getrandbits(32) for _ in range(6000)} | {7 ^ 1 << a ^ 1 << b for a in range(32) for b in range(32)})
    distinct = spark.createDataFrame([(v,) for v in values], "fp bigint")
    trees = -(-len(values) // 32)
    rows = simhash._cells(distinct, 2, 32).count()
    assert trees > 200 and rows < 40 * len(values)
    edges = simhash.links(distinct, 2, 32)
    found = {r.node: r.root for r in simhash.components(edges).collect()}
    cloud = {found[v] for v in values if (v ^ 7).bit_count() <= 2}
    assert len(cloud) == 1
