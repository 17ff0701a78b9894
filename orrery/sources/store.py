"""Parquet landing and metric sinks."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of the metric sink; a writer may leave out all but ``run_id`` and ``epoch``.
METRICS = {"run_id": "string", "epoch": "int", "split": "string", "task": "string", "class": "int", "auc": "double",
           "loss": "double", "rows": "long", "seconds": "double"}
#: Buckets of landed tables that are aligned with one another.
BUCKETS = 64


def compact(df: DataFrame, path: str, id_col: str = "record_id", num_partitions: int | None = None) -> DataFrame:
    """Land records once as Parquet, range-partitioned and sorted by id.

    Later reads prune by Parquet min/max statistics on the id instead of
    re-parsing thousands of tiny files every epoch.  Overwrite makes a rerun
    idempotent.
    """
    count = [num_partitions] if num_partitions else []  # without one, adaptive execution sizes the files by bytes
    (df.repartitionByRange(*count, id_col).sortWithinPartitions(id_col)
       .write.mode("overwrite").parquet(path))
    return df.sparkSession.read.parquet(path)


# ---------------------------------------------------------------- landing for alignment

def land(df: DataFrame, path: str, id_col: str = "record_id", buckets: int = BUCKETS) -> DataFrame:
    """S5 for tables that are aligned (J1, J2): Parquet in ``buckets`` files by a hash of the id, each sorted by id.

    One shuffle when a table lands, and none whenever it is joined by id with
    others of as many buckets (``align_landed``).  Overwrite makes a rerun
    idempotent.  The bucketing is written beside the table, so any session can
    open it (``open_landed``).
    """
    spark = df.sparkSession
    name = _table_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # this session's name for the path; files stay
    (df.repartition(buckets, id_col).sortWithinPartitions(id_col).write.mode("overwrite")
       .bucketBy(buckets, id_col).sortBy(id_col).option("path", path).saveAsTable(name))
    spec = spark.createDataFrame([(id_col, buckets, df.schema.json())], "id_col string, buckets int, columns string")
    spec.coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}.bucketing")
    return spark.table(name)


def open_landed(spark: SparkSession, path: str) -> DataFrame:
    """A table that ``land`` wrote, with its bucketing."""
    from pyspark.sql.types import StructType
    import json
    spec = spark.read.schema("id_col string, buckets int, columns string").json(f"{path.rstrip('/')}.bucketing").first()
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(json.loads(spec["columns"])))
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{spec['id_col']}`) "
                  f"SORTED BY (`{spec['id_col']}`) INTO {spec['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def _table_name(path: str) -> str:
    return "landed_" + hashlib.sha1(path.rstrip("/").encode()).hexdigest()[:16]


# ---------------------------------------------------------------- metrics

def write_metrics(df: DataFrame, path: str) -> None:
    """Metric rows, partitioned by run and epoch; writing an epoch of a run again replaces its rows.

    Dynamic partition overwrite: Spark stages the partitions of ``df`` and
    swaps them in when the job commits, so a retry after a lost driver leaves
    one copy and other epochs are not touched.
    """
    missing = {"run_id", "epoch"} - set(df.columns)
    if missing:
        raise ValueError(f"metric rows need {sorted(missing)}")
    unknown = set(df.columns) - set(METRICS)
    if unknown:
        raise ValueError(f"no such metric columns: {sorted(unknown)}")
    rows = df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in METRICS.items()])
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id", "epoch").parquet(path))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(", ".join(f"`{c}` {t}" for c, t in METRICS.items())).parquet(path)
