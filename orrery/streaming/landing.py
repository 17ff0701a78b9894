"""Incremental landing of numbered record files with Structured Streaming (S1 + S5).

Records arrive as new ``<id>.csv`` files; a file-source stream parses them
strictly and appends them to a Parquet table through the exactly-once file
sink.  The checkpoint lives in the shared folder, so a restarted job resumes
where it stopped; ``availableNow`` processes what has arrived and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.numbered import numbers, record_id_col, strict_csv


#: Bytes of files in one micro-batch.  The source scans its list of all files and both logs are compacted every few
#: batches, so batches of so many files make the work quadratic in the files.
BATCH_BYTES = 32 << 20


def numbered_csv_stream(spark: SparkSession, path: str, width: int, max_files_per_trigger: int | None = None,
                        name: str = "features", max_bytes_per_trigger: int = BATCH_BYTES) -> DataFrame:
    """(record_id, <name>) of files as they arrive, as strict as the batch form.

    A batch holds ``max_bytes_per_trigger`` of files, or ``max_files_per_trigger`` if that is given.
    """
    bound = (("maxBytesPerTrigger", max_bytes_per_trigger) if max_files_per_trigger is None
             else ("maxFilesPerTrigger", max_files_per_trigger))
    raw = strict_csv(spark.readStream, width).option(*bound).csv(path)
    return raw.select(record_id_col().alias("record_id"), numbers(width).alias(name))


def land_numbered_csv(spark: SparkSession, src: str, width: int, out: str, checkpoint: str,
                      max_files_per_trigger: int | None = None,
                      max_bytes_per_trigger: int = BATCH_BYTES) -> DataFrame:
    """Append every file that has arrived under ``src`` to the Parquet table ``out``; return the table."""
    q = (numbered_csv_stream(spark, src, width, max_files_per_trigger, max_bytes_per_trigger=max_bytes_per_trigger)
         .writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)
