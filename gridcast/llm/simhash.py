"""SimHash fingerprints and near-duplicate groups by BK-trees.

A document's fingerprint has a bit set where over half of its shingle hashes have
it set.  Fingerprints within ``radius`` bits link; a group is what links reach.

Equal texts are merged before any search, so copies cost one aggregate.  Two
fingerprints within ``radius`` bits agree on at least two of ``radius + 2`` bit
blocks, so a shard is one value of two blocks, and every link lies inside a shard.
Each shard is indexed by BK-trees of at most ``tree_size`` nodes (children keyed by
the integer Hamming distance to the parent), each shipped to all of the shard's
fingerprints; a search follows only the edges within ``radius`` of its distance.
The trees go by shuffle and not by broadcast: all trees together grow with the
input, and one tree is needed only by its shard.  A shard of more values than a tree
holds is cut again by two blocks of its other bits, and what is still larger into
several trees, whose queries are dealt over several tasks.

A shard gives no pairs, only one edge from each fingerprint to what it links with in
each tree: a forest with the same components.  Components come from alternating
large-star and small-star rounds, each a ``min`` aggregate and a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.llm.common import ascii_lower, checkpointed, small_batches, space_words, unused

BITS = 64


def shingle_hashes(words: Column, length: int) -> Column:
    """XXH64 (seed 42) of every ``length``-word shingle, repeats included; fewer words: of all; no word: none."""
    n = F.size(words)
    joined = F.transform(
        F.sequence(F.lit(0), n - length),
        lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(words, i + k) for k in range(length)])),
    )
    return F.when(n >= length, joined).when(n > 0, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(
        F.array().cast("array<bigint>"))


def majority(hashes: np.ndarray, block: int = 1 << 18) -> int:
    """The 64 majority bits as a signed integer; no hashes: 0."""
    if len(hashes) == 0:
        return 0
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), block):
        part = np.ascontiguousarray(hashes[start:start + block], np.int64).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


@F.pandas_udf(T.LongType())
def _majority(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield pd.Series([majority(h) for h in batch], dtype="int64")


def fingerprints(docs: DataFrame, shingle: int, key: str, text: str) -> DataFrame:
    """(key, fp) of every row: the 64 bits as a signed integer; a null or wordless text has 0."""
    worded = small_batches(docs).select(F.col(key).alias("key"), space_words(ascii_lower(F.col(text))).alias("words"))
    hashed = worded.select("key", shingle_hashes(F.col("words"), shingle).alias("hashes"))
    return hashed.select("key", _majority("hashes").alias("fp"))


class BKTree:
    """Nodes hold a fingerprint; children are keyed by their Hamming distance to the parent."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        if self.values:
            node = 0
            while True:
                distance = (value ^ self.values[node]).bit_count()
                following = self.children[node].get(distance)
                if following is None:
                    self.children[node][distance] = len(self.values)
                    break
                node = following
        self.values.append(value)
        self.children.append({})

    def within(self, value: int, radius: int) -> list[int]:
        """Numbers of the nodes within ``radius``: only edges in [d - radius, d + radius] can lead to one."""
        found, todo = [], [0] if self.values else []
        while todo:
            node = todo.pop()
            distance = (value ^ self.values[node]).bit_count()
            if distance <= radius:
                found.append(node)
            children = self.children[node]
            for edge in range(max(0, distance - radius), distance + radius + 1):
                following = children.get(edge)
                if following is not None:
                    todo.append(following)
        return found


def _find(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def tree_links(tree: BKTree, queries: list[int], radius: int) -> list[tuple[int, int]]:
    """Edges with the components of all links between ``queries`` and the tree's nodes.

    Each query gives one edge to the class it touches first; further classes it touches are
    joined to that one, each by one edge, so there are at most queries + nodes edges.
    """
    parent, edges = list(range(len(tree.values))), []
    for query in queries:
        near = tree.within(query, radius)
        if not near:
            continue
        root = _find(parent, near[0])
        if tree.values[root] != query:
            edges.append((query, tree.values[root]))
        for node in near[1:]:
            other = _find(parent, node)
            if other != root:
                parent[other] = root
                edges.append((tree.values[other], tree.values[root]))
    return edges


#: Shards that are over the size of a tree are cut again while more than this many of their bits are free.
FREE_BITS = 16
#: Bits of a fingerprint, as (first bit, width).
Bits = list[tuple[int, int]]


@dataclass
class Band:
    """Shards by the values of some bits."""

    fixed: Bits
    free: Bits

    def value(self) -> Column:
        """The fixed bits of ``fp``, side by side; no bits: 0."""
        value = F.lit(0).cast("long")
        for first, width in self.fixed:
            mask = F.lit((1 << width) - 1 if width < BITS else -1).cast("long")
            value = F.shiftleft(value, width).bitwiseOR(F.shiftrightunsigned("fp", first).bitwiseAND(mask))
        return value

    def cut(self, radius: int) -> list[Band]:
        """Bands that also fix two of ``radius + 2`` blocks of the free bits: fingerprints of one shard that differ in at
        most ``radius`` bits agree on two blocks at least, so each link lies in a shard of one of these bands."""
        places = [first + k for first, width in self.free for k in range(width)]
        cuts = [len(places) * k // (radius + 2) for k in range(radius + 3)]
        blocks = [places[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        found = []
        for pair in combinations(range(len(blocks)), 2):
            own = [x for k in pair for x in blocks[k]]
            rest = [x for k, block in enumerate(blocks) if k not in pair for x in block]
            found.append(Band([*self.fixed, *_runs(own)], _runs(rest)))
        return found


def _runs(places: list[int]) -> Bits:
    """Neighbouring bits as (first, width)."""
    runs: Bits = []
    for x in places:
        if runs and x == sum(runs[-1]):
            runs[-1] = (runs[-1][0], runs[-1][1] + 1)
        else:
            runs.append((x, 1))
    return runs


def _dealt(bands: list[Band], start: int = 0) -> Column:
    """(band, value) of ``fp`` for each band; bands are numbered from ``start``."""
    return F.array(*[F.struct(F.lit(k).alias("band"), b.value().alias("value")) for k, b in enumerate(bands, start)])


CELL = ["level", "band", "value", "tree", "queries"]


def _search(radius: int):
    """Rows sorted by cell, nodes first: builds each cell's tree and searches it; one cell is held at a time."""

    def table(edges: list[tuple[int, int]]) -> pd.DataFrame:
        return pd.DataFrame(np.array(edges, np.uint64).reshape(-1, 2).view(np.int64), columns=["a", "b"])

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, tree, queries = None, BKTree(), []
        for batch in batches:
            if batch.empty:
                continue
            keys, edges = batch[CELL].to_numpy(), []
            values, is_node = batch["fp"].to_numpy(np.int64).view(np.uint64), batch["node"].to_numpy(bool)
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            for start, end in zip(starts, [*starts[1:], len(keys)], strict=True):
                if cell != tuple(keys[start]):
                    edges += tree_links(tree, queries, radius)
                    cell, tree, queries = tuple(keys[start]), BKTree(), []
                nodes = is_node[start:end]
                for value in values[start:end][nodes].tolist():
                    tree.add(value)
                queries += values[start:end][~nodes].tolist()
            if edges:
                yield table(edges)
        if edges := tree_links(tree, queries, radius):
            yield table(edges)

    return search


def links(distinct: DataFrame, radius: int, tree_size: int = 2048) -> DataFrame:
    """Edges (a, b) with the same components as all pairs within ``radius`` bits.

    ``distinct``: distinct values in the bigint column ``fp``.
    """
    gathered = _cells(distinct, radius, tree_size).repartition(*CELL).sortWithinPartitions(*CELL, F.desc("node"), "fp")
    return gathered.mapInPandas(_search(radius), "a bigint, b bigint")


def _shards(distinct: DataFrame, radius: int, tree_size: int) -> DataFrame:
    """(level, band, value, fp, n): the shards with more than one member.

    A shard over ``tree_size`` is cut again by two blocks of its free bits, while over ``FREE_BITS`` are free.  So a shard
    that stays over ``tree_size`` has at most 2 ** ``FREE_BITS`` members, whatever the input.
    """
    bands = Band([], [(0, BITS)]).cut(radius)
    dealt = distinct.select("fp", F.inline(_dealt(bands)))
    found, level = [], 0
    while True:
        sizes = dealt.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        members = checkpointed(dealt.join(sizes, ["band", "value"]).select(F.lit(level).alias("level"), "band", "value", "fp", "n"))
        open_bands = [sum(width for _, width in b.free) > FREE_BITS for b in bands]
        hot = (F.col("n") > tree_size) & F.element_at(F.array(*[F.lit(x) for x in open_bands]), F.col("band") + 1)
        if not any(open_bands) or members.where(hot).isEmpty():
            return reduce(DataFrame.unionByName, [*found, members])
        found.append(members.where(~hot))
        cuts = [b.cut(radius) for b in bands]
        starts = [sum(len(c) for c in cuts[:k]) for k in range(len(cuts))]
        narrow = F.array().cast("array<struct<band:int,value:bigint>>")
        for k, parts in enumerate(cuts):
            narrow = F.when(F.col("band") == k, _dealt(parts, starts[k])).otherwise(narrow)
        dealt = members.where(hot).select("fp", F.inline(narrow))
        bands, level = [b for c in cuts for b in c], level + 1


def _cells(distinct: DataFrame, radius: int, tree_size: int) -> DataFrame:
    """Rows (cell, fp, node) of the searches.

    A shard's values are dealt by hash into parts of about ``tree_size``; each cell (a part as tree, an equal or later part
    as queries) is a group of its own, so a task holds about two parts at a time.  A value has two rows in a shard of one
    part, and in a larger one a row for each part and one more: 33 with trees of 2,048.  A radius of 2 has 6 shards for
    each value, and 36 where all of them are hot, so rows grow in step with the values.
    """
    members = (
        _shards(distinct, radius, tree_size)
        .withColumn("parts", F.ceil(F.col("n") / tree_size).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    )
    cells = F.concat(
        F.transform(F.sequence(F.col("own"), F.col("parts") - 1),
                    lambda q: F.struct(F.col("own").alias("tree"), q.alias("queries"), F.lit(True).alias("node"))),
        F.transform(F.sequence(F.lit(0), F.col("own")),
                    lambda t: F.struct(t.alias("tree"), F.col("own").alias("queries"), F.lit(False).alias("node"))),
    )
    return members.select("level", "band", "value", "fp", F.explode(cells).alias("c")).select(
        "level", "band", "value", "c.*", "fp")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node of its component.

    Alternating large-star and small-star rounds until nothing changes; the number of rounds grows with
    the logarithm of the longest chain.  A node with very many neighbours costs a combined ``min`` and a join
    that adaptive execution splits.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs, before = checkpointed(pairs), None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # every pair has v < u: the smaller neighbours of u, and u itself, go under the smallest of them
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        pairs = checkpointed(small.where("u <> v").distinct())
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_groups(docs: DataFrame, shingle: int, radius: int, key: str = "doc_id", text: str = "text",
                tree_size: int = 2048) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` with their fingerprints, and the group of each fingerprint.

    Returns ``(key, fp)`` for every row, and ``(fp, root, component_id)`` for every fingerprint: ``root`` names the
    group, ``component_id`` is its smallest key (null if it has none but null keys).
    Null and wordless texts have fingerprint zero and link like any other; repeated rows link with each other;
    an empty table gives empty tables.  Further columns of ``docs`` are not read.
    """
    marked = checkpointed(fingerprints(docs, shingle, key, text))
    first = marked.groupBy("fp").agg(F.min("key").alias("least"))
    roots = components(links(first.select("fp"), radius, tree_size))
    named = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked, checkpointed(named.select("fp", "root").join(least, "root").select("fp", "root", "component_id"))


def groups(docs: DataFrame, shingle: int, radius: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, fingerprint (16 hex digits) and component_id of every row; see ``near_groups`` for the odd cases."""
    marked, named = near_groups(docs, shingle, radius, key, text)
    return marked.join(named, "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, shingle: int, radius: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` from each group, all its columns: a row with the smallest key.

    Of its rows with that key one with the smallest text hash stays, of several such rows the one whose other columns, as
    JSON, have the smallest hash.  A group whose keys are all null keeps one row.  A key may have several texts: each row is
    ranked by key and text hash, so it stands for its own group alone.  Columns may have any names.
    """
    rank = F.struct(F.col(f"`{key}`").isNull().alias("nameless"), F.col(f"`{key}`").alias("key"),
                    F.xxhash64(F.col(f"`{text}`")).alias("text"))
    ranked = docs.select(rank.alias("rank"), F.col(f"`{text}`").alias("text"))
    _, named = near_groups(ranked, shingle, radius, "rank", "text")
    taken = list(docs.columns)
    names = {}
    for name in ("rank", "tie", "place"):
        names[name] = unused(taken, name)
        taken.append(names[name])
    chosen = named.select(F.col("component_id").alias(names["rank"])).distinct()
    others = F.to_json(F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`") for c in docs.columns if c != text]))
    rows = docs.withColumns({names["rank"]: rank, names["tie"]: F.xxhash64(others)})
    # one row of a rank from each task, then one of all
    first = F.row_number().over(Window.partitionBy(names["rank"]).orderBy(names["tie"]))
    once = rows.withColumn(names["place"], first).where(F.col(names["place"]) == 1)
    return once.join(chosen, names["rank"], "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
