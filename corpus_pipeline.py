"""The corpus pipeline: language ID, toxicity, near duplicates, packing.

Each stage is ``(name, function)``; a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's docs.  All but the last return the columns of ``documents``; the last
returns the batches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.llm import langid, packing, simhash, toxicity
from gridcast.llm.common import fold, table, unused
from gridcast.llm.queries import RADIUS, SHINGLE, toxicity_model
from gridcast.session import staging_root

#: Documents that are nearer to no language than this are rejected, as are those without a letter.  A text whose
#: n-grams are all foreign to every profile scores 0; prose of the learned languages, mixed or noisy, 0.45 and more.
LEAST_SCORE = 0.15

#: SQL for the rows of ``run``: none, the stages learn models.
ORACLE_SQL = None


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is known; profiles are learned outside fold 2 of 4."""
    profiles = langid.learn(docs.where(fold("doc_id", 4) != 2))
    into = unused(docs.columns, "__language")
    kept = (F.col(f"{into}.lang_pred") != "und") & (F.col(f"{into}.score") >= LEAST_SCORE)
    return langid.identify(docs, profiles, into=into).where(kept).drop(into)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that score under one half."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    into = unused(docs.columns, "__toxicity")
    return toxicity.scored(docs, model, into=into).where(F.col(f"{into}.score") < 0.5).drop(into)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group, the one with the smallest doc_id."""
    return simhash.representatives(docs, SHINGLE, RADIUS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batch, slot and padded length of every document."""
    return packing.pack(docs)


STAGES = [
    ("language id", identified),
    ("toxicity", without_toxic),
    ("simhash near-dedup", without_near_copies),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage gives is kept under ``spark.checkpoint.dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{staging_root(spark)}/pipeline-{uuid.uuid4().hex}/{name.replace(' ', '-')}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERIES = {"pipeline": run}
