"""Reading the given tables and the record-level data Spark derives from them."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hours(df: DataFrame, col: str):
    """Hours since the epoch, as double, independent of the session time zone."""
    from ..functions.timecols import epoch_hours
    return epoch_hours(df, col)


def fingerprint(spark: SparkSession, sf_dir: str, *names: str) -> str:
    """Changes with the files of the given tables: their names, lengths and times."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    seen = []
    for name in names:
        path = hadoop.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path):
            seen.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha1(repr(sorted(seen)).encode()).hexdigest()[:16]
