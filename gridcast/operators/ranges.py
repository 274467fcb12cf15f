"""Rows of one long order over many tasks: consecutive ranges of nearly equal size.

Spark's range partitioner finds where the ranges start; a row finds its range by binary search in the array of these
starts, which is bounded by the number of ranges.  So work that needs neighbours in the order (positions, the next row)
runs range by range, and only what crosses a border takes a second look.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a range, and ranges at most: beyond, ranges grow.  The array of starts is sent to all tasks.
RANGE_ROWS, MOST_RANGES = 1024, 1 << 16


@dataclass
class Ranges:
    """Consecutive ranges of an order, by the first key of each."""

    starts: DataFrame  # one row: the sorted array of the first keys
    count: int

    def _starts(self) -> Column:
        return self.starts.scalar()

    def number(self, rows: DataFrame, key: str, out: str) -> DataFrame:
        """``rows`` with the range of the column ``key`` in ``out``, from 0; keys before the first start are in the first
        range.  One comparison for each binary digit of the number of ranges."""
        starts, at = self._starts(), F.col(out)
        rows = rows.withColumn(out, F.lit(0))
        for k in reversed(range(self.count.bit_length())):
            ahead = F.get(starts, at + F.lit((1 << k) - 1)) <= F.col(key)
            rows = rows.withColumn(out, F.when(ahead, at + F.lit(1 << k)).otherwise(at))
        return rows.withColumn(out, F.greatest(at - 1, F.lit(0)))

    def is_start(self, key: Column, number: Column) -> Column:
        return F.get(self._starts(), number) == key


def find_ranges(keys: DataFrame, order: Sequence[str], rows: int = RANGE_ROWS, total: int | None = None) -> Ranges | None:
    """Ranges of about ``rows`` rows of the rows of ``keys`` by the columns ``order``, ascending; None for no rows.

    Only these columns are read (twice: a count and a sample, then the ranges).  Rows with equal keys are in one range.
    A caller that knows the number of rows gives it as ``total``.
    """
    plain = keys.select(*order)
    total = plain.count() if total is None else total
    if not total:
        return None
    parts = min(MOST_RANGES, -(-total // rows))
    dealt = plain.repartitionByRange(parts, *order) if parts > 1 else plain
    firsts = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct(*order)).alias("key")) if parts > 1 \
        else dealt.agg(F.min(F.struct(*order)).alias("key"))
    found = sorted_keys(firsts)
    return Ranges(found, len(found.first()[0]))


def sorted_keys(firsts: DataFrame) -> DataFrame:
    """One row that stays as it is: the sorted array of ``key``."""
    gathered = firsts.agg(F.sort_array(F.collect_set("key")).alias("starts"))
    kind = T.StructType([T.StructField("starts", gathered.schema["starts"].dataType)])
    return firsts.sparkSession.createDataFrame([(gathered.first()["starts"],)], kind)
