"""Words, folds, table access and checkpoints that the operators share."""

from __future__ import annotations

import pickle
import string
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.session import staging_root

#: ASCII white space, by which a text falls into words.
SPACE = r"[\x20\x09-\x0D]+"
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; a null key has fold null."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(parts))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else, whatever the locale."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def space_words(text: Column) -> Column:
    """The maximal runs without ASCII white space, in order; a null text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(ASCII_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def unused(columns: Sequence[str], name: str) -> str:
    """``name``, with underscores behind it until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_slices(texts: pa.Array, chars: int = 1 << 20) -> Iterator[pa.Array]:
    """Stretches of neighbouring texts with about ``chars`` characters each, one text at least."""
    ends, start = np.cumsum(pc.utf8_length(texts).fill_null(0).to_numpy()), 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + chars, "right")))
        yield texts.slice(start, end - start)
        start = end


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the shared folder of ``spark.checkpoint.dir``.

    Lost executors cost a re-read of these files.  Only where the session names no
    folder, as in tests, one is set.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(staging_root(df.sparkSession))
    return df.checkpoint()


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(key, text, label) of about ``rows`` labelled documents: all, or those with the lowest key hashes.

    A key with several labels takes the largest; of its rows the one with the smallest text hash, a null text last, so a
    key counts once however many rows it has.  The labels kept are at most ``2 * rows`` (checked), and so are the rows of
    the result.  Labels are sent to the documents; only sampled texts are shuffled, one of a key from each task.  Rows
    without key or label are left out.
    """
    one = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.max(label).alias(label))
    steps, total = 1 << 30, one.count()
    kept = one if total <= rows else one.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(steps)) < steps * rows // total)
    if kept.count() > 2 * rows:
        raise ValueError("the sample of labels is over its bound")
    known = docs.select(key, F.col(text).alias("text")).join(F.broadcast(kept), key)
    first = F.min_by("text", F.struct(F.col("text").isNull(), F.xxhash64("text")))
    return known.groupBy(key, label).agg(first.alias("text")).select(key, "text", label)


#: Rows that go to Python at a time.  Documents and their token arrays are long: the default of 10,000 rows can be
#: hundreds of megabytes on either side.
BATCH_ROWS = 1000


class _Whole:
    """Pickles as its value with the code that the value needs."""

    def __init__(self, value):
        self.value = value

    def __reduce__(self):
        return pickle.loads, (cloudpickle.dumps(self.value),)


def shipped(spark: SparkSession, value) -> Broadcast:
    """Broadcast an object of this package to executors that need no copy of the package.

    In tasks ``value`` of the result is the object itself, once for each Python worker.
    """
    return spark.sparkContext.broadcast(_Whole(value))


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches are small; a session that sets their size itself keeps it."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if conf.get(setting, None) is None:
        conf.set(setting, str(BATCH_ROWS))
    return df
