"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch has the k smallest distinct hashes of a text's shingles.  Hashes are spread evenly, so the smallest ones are a
sample of all shingles, and the same one for every text: what two sketches share under their common horizon estimates
resemblance and containment, and how close together the hashes lie gives the number of distinct shingles.  Sketches of
parts merge to the sketch of the whole.  All of it is expressions on columns.

A document's neighbour in the order of the corpus comes from ranges of that order (``gridcast.operators.ranges``): texts
are shuffled once, to their range, with a copy of the first row of each range for the range before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.common import ascii_lower, checkpointed, space_words
from gridcast.llm.simhash import shingle_hashes
from gridcast.operators.ranges import MOST_RANGES, RANGE_ROWS, find_ranges

#: Words of a shingle, and hashes of a sketch.
SHINGLE, K = 5, 128
#: Copies of a row that are written out at a time.
COPIES = 1 << 16


def sketch(hashes: Column, k: int = K) -> Column:
    """The ``k`` smallest distinct hashes, in order; of no hashes none."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def with_sketch(rows: DataFrame, text: Column, into: str, shingle: int = SHINGLE, k: int = K) -> DataFrame:
    """``rows`` with the sketch of ``text`` (never null) in the column ``into``.

    Words are parted by ASCII white space, A-Z lower-cased; a text with fewer than ``shingle`` words is one shingle, one
    without a word has none.
    """
    words, hashes = f"{into}_words", f"{into}_hashes"
    worded = rows.withColumn(words, space_words(ascii_lower(text)))
    hashed = worded.withColumn(hashes, shingle_hashes(F.col(words), shingle)).drop(words)
    return hashed.withColumn(into, sketch(F.col(hashes), k)).drop(hashes)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two texts' shingles together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_parts(parts: DataFrame, keys: Sequence[str], column: str, k: int = K) -> DataFrame:
    """(keys, column): the sketches of each key's parts as one.

    Each task first keeps the ``k`` smallest hashes of a key, so a key with very many parts costs one task ``k`` rows from
    every other.  A key whose parts are all empty or null has an empty sketch.
    """
    names = [f"key{i}" for i in range(len(keys))]
    rows = parts.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keys, names, strict=True)], F.col(f"`{column}`").alias("sketch"))
    hashes = rows.select(*names, F.explode("sketch").alias("hash")).distinct()
    place = F.row_number().over(Window.partitionBy(*names).orderBy("hash"))
    kept = hashes.withColumn("place", place).where(F.col("place") <= k).groupBy(*names).agg(
        F.sort_array(F.collect_list("hash")).alias("sketch"))
    empty = rows.select(*names).distinct().withColumn("sketch", F.array().cast("array<bigint>"))
    both = kept.unionByName(empty).groupBy(*names).agg(F.max_by("sketch", F.size("sketch")).alias("sketch"))
    return both.toDF(*keys, column)


def _horizon(a: Column, b: Column, k: int) -> Column:
    """The largest hash up to which both sketches know all of their shingles."""
    least = F.lit((1 << 63) - 1)
    return F.least(*[F.when(F.size(x) < k, least).otherwise(F.element_at(x, -1)) for x in (a, b)])


def _under(a: Column, limit: Column) -> Column:
    return F.size(F.filter(a, lambda h: h <= limit))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Shared shingles over all shingles of both texts, 0 to 1; exact for texts of under ``k`` shingles, 1 for two texts
    without any."""
    limit = _horizon(a, b, k)
    whole = _under(F.array_union(a, b), limit)
    return F.when(whole == 0, F.lit(1.0)).otherwise(_under(F.array_intersect(a, b), limit) / whole)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """The share of the first text's shingles that the second one has, 0 to 1; 1 for a text without any."""
    limit = _horizon(a, b, k)
    whole = _under(a, limit)
    return F.when(whole == 0, F.lit(1.0)).otherwise(_under(F.array_intersect(a, b), limit) / whole)


def shingle_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact under ``k``."""
    share = (F.element_at(a, -1).cast("double") + 2.0 ** 63) / 2.0 ** 64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def printed(a: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


ORDER = ["keyless", "after", "hash"]


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, k: int = K,
              range_rows: int = RANGE_ROWS) -> tuple[DataFrame, bool]:
    """(key, text, sketch, next_text, next_sketch, copies): every row with the next one in descending order of the key.

    ``key``: a bigint.  Rows with equal keys are in the order of their text hashes, rows with a null key come last, and
    after the last comes the first; a single row follows itself.  A null text counts as empty.  Equal rows follow each
    other; where very many are equal, they are one row here, with ``copies``: all but the last of them follow themselves.
    An empty table gives an empty one.  Also returns whether there are such rows.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = docs.select(F.col(f"`{key}`").alias("key"), whole.alias("text")).select(
        F.col("key").isNull().alias("keyless"), F.bitwise_not(F.coalesce("key", F.lit(0).cast("bigint"))).alias("after"),
        F.xxhash64("text").alias("hash"), "key", "text")
    ids = checkpointed(base.select(*ORDER))
    ranges = find_ranges(ids, ORDER, range_rows)
    if ranges is None:
        none = F.array().cast("array<bigint>")
        return base.select("key", "text", none.alias("sketch"), F.col("text").alias("next_text"), none.alias("next_sketch"),
                           F.lit(1).cast("bigint").alias("copies")), False
    total = ids.count()
    # at most MOST_RANGES keys have so many rows
    most = max(range_rows, -(-total // MOST_RANGES))
    heavy = checkpointed(ids.groupBy(*ORDER).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > most))
    rows = base.withColumn("copies", F.lit(1).cast("bigint"))
    many = heavy.count() > 0
    if many:
        light = base.join(F.broadcast(heavy.drop("copies")), ORDER, "left_anti").withColumn("copies", F.lit(1).cast("bigint"))
        once = base.join(F.broadcast(heavy), ORDER).groupBy(*ORDER, "copies").agg(F.first("key").alias("key"), F.first("text").alias("text"))
        rows = light.unionByName(once)
    at = ranges.number(rows.withColumn("order", F.struct(*ORDER)), "order", "range")
    own = F.struct(F.col("range"), F.lit(False).alias("halo"))
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(ranges.count)).alias("range"), F.lit(True).alias("halo"))
    places = F.when(ranges.is_start(F.col("order"), F.col("range")), F.array(own, before)).otherwise(F.array(own))
    placed = at.withColumn("place", F.explode(places)).select("place.*", *ORDER, "key", "text", "copies")
    dealt = with_sketch(placed.repartition("range"), F.col("text"), "sketch", shingle, k)
    after = Window.partitionBy("range").orderBy("halo", *ORDER, "text")
    following = dealt.withColumn("next", F.lead(F.struct("text", "sketch")).over(after)).where(~F.col("halo"))
    return following.select("key", "text", "sketch", F.col("next.text").alias("next_text"),
                            F.col("next.sketch").alias("next_sketch"), "copies"), many


def fingerprinted(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, k: int = K,
                  range_rows: int = RANGE_ROWS) -> DataFrame:
    """Every row's key, length, fingerprint and likeness to an edited text and to the next document.

    The edited text is the text with its last floor(n / 2) of n code points replaced by as many of the next document from
    its start on, or by all of it; the next document is that of ``with_next``, which states the odd cases.  Two texts
    without a word are alike (1), one without and one with words are not (0).  Repeated rows each get a result; further
    columns are not read.
    """
    neighbours, many = with_next(docs, key, text, shingle, k, range_rows)
    repeated = F.when(F.col("copies") > 1, F.array(
        F.struct("next_text", "next_sketch", F.lit(1).cast("bigint").alias("copies")),
        F.struct(F.col("text").alias("next_text"), F.col("sketch").alias("next_sketch"), (F.col("copies") - 1).alias("copies")),
    )).otherwise(F.array(F.struct("next_text", "next_sketch", "copies")))
    rows = neighbours.select("key", "text", "sketch", F.explode(repeated).alias("r")).select("key", "text", "sketch", "r.*")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = rows.withColumn("n_chars", n.cast("bigint")).withColumn("edited", F.concat(
        F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)))
    both = with_sketch(edited, F.col("edited"), "edited_sketch", shingle, k)
    a, e, b = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    found = both.select(
        F.col("key").alias("key"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), printed(a).alias("fingerprint"),
        printed(e).alias("edited_fingerprint"), resemblance(a, e, k).alias("near_edited"), resemblance(a, b, k).alias("near_next"),
        containment(e, a, k).alias("edited_in_text"), shingle_count(a, k).alias("n_shingles"), "copies")
    return (written_out(found) if many else found.drop("copies")).withColumnRenamed("key", key)


def written_out(rows: DataFrame) -> DataFrame:
    """Each row as often as ``copies`` says, without that column.  The copies of a row are dealt out in blocks."""
    rows = checkpointed(rows)
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / COPIES))
    block = rows.where("copies > 1").withColumn("block", F.explode(blocks)).repartition("key", "fingerprint", "edited_fingerprint", "block")
    size = F.least(F.lit(COPIES).cast("bigint"), F.col("copies") - F.col("block") * COPIES)
    written = block.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), size))).drop("block", "copy", "copies")
    return rows.where("copies = 1").drop("copies").unionByName(written)
