"""Packing into length buckets that waste the least padding, and batches of a token budget inside each bucket.

Every row is padded to its bucket's boundary.  Dynamic programming over the rows of each distinct length chooses the
boundaries, so no others give less padding, whatever the corpus.  Its cost for a boundary is a lower envelope of lines,
so a bucket takes time in proportion to the distinct lengths.  These are few: ``d`` distinct lengths need a corpus of at
least ``d * d / 2`` words, so 20 trillion words have 6.3 million at most.  The driver holds two numbers for each, and one
per bucket while it chooses, in arrays.

Batches are cut from a running number of the rows of a bucket.  The number comes from the row's place within its own
part of the (checkpointed) lengths plus the counts of the parts before, so no task sees a whole bucket.
"""

from __future__ import annotations

from array import array
from bisect import bisect_right
from collections import deque
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.common import checkpointed, space_words


def token_length(text: Column) -> Column:
    """White-space words and one end mark; a null or empty text has length 1."""
    return F.size(space_words(text)).cast("long") + 1


def histogram(lengths: DataFrame) -> tuple[array, array]:
    """The distinct lengths, ascending, and the rows of each."""
    counts = lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).orderBy("n_tokens").toArrow()
    return tuple(array("q", counts.column(c).to_numpy().tobytes()) for c in ("n_tokens", "n"))


def best_boundaries(lengths: Sequence[int], counts: Sequence[int], buckets: int) -> tuple[list[int], int]:
    """At most ``buckets`` boundaries, all distinct ``lengths`` (ascending), with the least padding; and that padding.

    cost[k][j]: the least padding of the first j lengths in k buckets, the least over i < j of cost[k - 1][i] and the
    padding of lengths i + 1 to j at that of j.  But for terms of j alone, that is a line in this length for each i,
    whose slope falls with i: the lower envelope of the lines is kept, and read from left to right.  Fewer buckets win a
    tie.
    """
    size = len(lengths)
    if not size:
        return [], 0
    rows = array("q", accumulate(counts, initial=0))
    tokens = array("q", accumulate((x * n for x, n in zip(lengths, counts, strict=True)), initial=0))
    nowhere = -1  # no lengths fill so many buckets
    cost = array("q", [0]) + array("q", [nowhere]) * size
    choices, best = [], None
    for k in range(1, min(buckets, size) + 1):
        following, chosen = array("q", [nowhere]) * (size + 1), array("q", [0]) * (size + 1)
        envelope = deque()  # (lengths before, value at 0)
        for j in range(k, size + 1):
            i, value = j - 1, cost[j - 1]
            if value != nowhere:
                value += tokens[i]
                while len(envelope) > 1:
                    (a, at_a), (b, at_b) = envelope[-2], envelope[-1]
                    if (value - at_a) * (rows[b] - rows[a]) > (at_b - at_a) * (rows[i] - rows[a]):
                        break
                    envelope.pop()
                envelope.append((i, value))
            x = lengths[j - 1]
            while len(envelope) > 1 and envelope[1][1] - rows[envelope[1][0]] * x < envelope[0][1] - rows[envelope[0][0]] * x:
                envelope.popleft()
            i, value = envelope[0]
            following[j], chosen[j] = value - rows[i] * x + x * rows[j] - tokens[j], i
        cost = following
        choices.append(chosen)
        if best is None or cost[size] < best[0]:
            best = (cost[size], k)
    cuts, j = [], size
    for chosen in reversed(choices[:best[1]]):
        cuts.append(lengths[j - 1])
        j = chosen[j]
    return cuts[::-1], best[0]


@dataclass
class Plan:
    boundaries: list[int]
    capacity: list[int]  # rows per batch
    first_batch: list[int]  # number of the first batch of each bucket
    padding: int


def plan_buckets(lengths: Sequence[int], counts: Sequence[int], buckets: int, budget: int) -> Plan:
    """Boundaries, and how many rows of each bucket fill a batch: the budget over the boundary, one at least."""
    boundaries, padding = best_boundaries(lengths, counts, buckets)
    capacity = [max(1, budget // b) for b in boundaries]
    ends = [bisect_right(lengths, b) for b in boundaries]
    rows = [sum(counts[i:j]) for i, j in zip([0, *ends], ends)]
    batches = [-(-r // c) for r, c in zip(rows, capacity, strict=True)]
    return Plan(boundaries, capacity, [sum(batches[:k]) for k in range(len(batches))], padding)


def _listed(values: list[int], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), at + 1)


def pack(docs: DataFrame, buckets: int = 16, budget: int = 32768, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, bucket, boundary, batch_id, slot) for every row.

    A batch holds rows of one bucket, at most ``budget`` tokens with padding; a row longer than the budget is a batch
    of its own.  All batches of a bucket but its last are full.  Null and empty texts have length 1; repeated rows and
    null keys are rows like any other; an empty table gives an empty one.  Further columns are not read.
    """
    lengths = checkpointed(docs.select(F.col(key).alias("key"), token_length(F.col(text)).alias("n_tokens")))
    plan = plan_buckets(*histogram(lengths), buckets, budget)
    if not plan.boundaries:
        plan = Plan([1], [1], [0], 0)
    bucket = sum(((F.col("n_tokens") > b).cast("int") for b in plan.boundaries[:-1]), F.lit(0))
    rows = lengths.select("key", "n_tokens", bucket.alias("bucket"), F.spark_partition_id().alias("part"))
    parts = rows.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("bucket").orderBy("part")) - F.col("n")
    offsets = parts.select("bucket", "part", before.alias("before"))
    place = F.row_number().over(Window.partitionBy("bucket", "part").orderBy(F.xxhash64("key"), "key", "n_tokens"))
    numbered = rows.withColumn("place", place).join(offsets, ["bucket", "part"])
    number = F.col("before") + F.col("place") - 1
    capacity = _listed(plan.capacity, F.col("bucket"))
    return numbered.select(
        F.col("key").alias(key), "n_tokens", "bucket", _listed(plan.boundaries, F.col("bucket")).alias("boundary"),
        (_listed(plan.first_batch, F.col("bucket")) + F.floor(number / capacity)).alias("batch_id"),
        F.pmod(number, capacity).cast("int").alias("slot"))
