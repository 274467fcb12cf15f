"""Session helpers: local test sessions and staging tables on shared storage."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "*", name: str = "gridcast") -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


@cache
def _local_root(application: str) -> tempfile.TemporaryDirectory:
    """Removed when the process ends."""
    return tempfile.TemporaryDirectory(prefix=f"gridcast-{application}-", ignore_cleanup_errors=True)


def staging_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder.  As with
    checkpoints, cleaning the folder is left to its owner.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return _local_root(spark.sparkContext.applicationId).name


def stage(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once and read it back.

    Work that reads the same features many times (one model per hour) reads the
    written table with partition pruning, and a lost executor costs a re-read of
    files and not a re-run of the whole preparation.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/stage-{uuid.uuid4().hex}"
    spread(df, by).write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Gather rows by ``by`` for writing; adaptive execution splits large values over many tasks."""
    return df.hint("rebalance", *[F.col(c) for c in by]) if by else df
