"""Prepared tables, forecasts and models on disk."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.util import MLReadable
from pyspark.sql import DataFrame, SparkSession

from gridcast.session import spread


def write_table(df: DataFrame, path: str, by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet, one folder per value of ``by``.

    Small values get one file, a large one is written by many tasks.
    """
    spread(df, tuple(by)).write.mode(mode).partitionBy(*by).parquet(path)


def replace_parts(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write the folders that ``df`` has rows for, in place of what they held; all other folders of the table stay.

    So one horizon or hour is prepared anew without the others.  A folder without rows in ``df`` is not emptied.
    """
    out = spread(df, tuple(by)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy(*by).parquet(path)


def write_feed(lines: DataFrame, root: str, kind: str) -> None:
    """Text feeds ``<root>/<series_id>/<kind>_<year>.txt`` from ``series_id, year, line``, in the order of ``line``.

    A feed is one file per site and year, so that many rows meet in one task.  Spark writes them next to the feeds;
    the driver then gives the files their names.
    """
    spark = lines.sparkSession
    fresh = f"{root}/_written-{kind}"
    dealt = lines.repartition("series_id", "year").sortWithinPartitions("series_id", "year", "line")
    dealt.write.partitionBy("series_id", "year").text(fresh)
    paths = spark._jvm.org.apache.hadoop.fs
    base = paths.Path(fresh)
    files = base.getFileSystem(spark._jsc.hadoopConfiguration())
    for site in files.listStatus(base):
        name = site.getPath().getName()
        if not name.startswith("series_id="):
            continue
        home = paths.Path(root, name.partition("=")[2])
        files.mkdirs(home)
        for year in files.listStatus(site.getPath()):
            parts = [p.getPath() for p in files.listStatus(year.getPath()) if p.getPath().getName().startswith("part-")]
            if len(parts) != 1:
                raise ValueError(f"{len(parts)} files for {year.getPath()}")
            number = year.getPath().getName().partition("=")[2]
            feed = paths.Path(home, f"{kind}_{number}.txt")
            files.delete(feed, False)
            if not files.rename(parts[0], feed):
                raise OSError(f"{parts[0]} could not become {feed}")
    files.delete(base, True)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Filters on the folder columns (year, horizon, hour) prune files."""
    return spark.read.parquet(path)


def read_prepared_csv(spark: SparkSession, path: str, schema: str, separator: str = ",") -> DataFrame:
    """Import of a prepared CSV with header; the schema is given, not inferred."""
    return spark.read.csv(path, schema=schema, header=True, sep=separator)


def save_models(models: dict, path: str, parallel: int = 8, by: Sequence[str] | None = None) -> None:
    """One folder per model key: ``hour=7`` or ``horizon=2/hour=7``, or by the names ``by`` of the key's parts.

    A model that is there already is replaced; the others stay.
    """

    def save(item):
        key, model = item
        model.write().overwrite().save(f"{path}/{_folder(key, by)}")

    with ThreadPoolExecutor(parallel) as pool:
        list(pool.map(save, models.items()))


def load_models(reader: type[MLReadable], path: str, keys: Iterable, parallel: int = 8, by: Sequence[str] | None = None) -> dict:
    """The models of ``keys``, read back."""
    keys = list(keys)
    with ThreadPoolExecutor(parallel) as pool:
        loaded = pool.map(lambda key: reader.load(f"{path}/{_folder(key, by)}"), keys)
        return dict(zip(keys, loaded, strict=True))


def _folder(key, by: Sequence[str] | None = None) -> str:
    parts = key if isinstance(key, tuple) else (key,)
    names = by or ("horizon", "hour")[-len(parts):]
    return "/".join(f"{name}={part}" for name, part in zip(names, parts, strict=True))
