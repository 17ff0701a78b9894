"""ROC histograms accumulated over a stream of scored batches (A3, streaming form).

The reference evaluates batch by batch into a ROC accumulator.  Here the
accumulator is Structured Streaming state: a grouped sum per (keys, bin),
at most ``steps + 1`` rows per group, so the state and the complete output
stay bounded however long the stream runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.auc import roc_histogram


def accumulate_histograms(spark: SparkSession, src: str, schema: str, keys: Sequence[str], out: str,
                          checkpoint: str, steps: int = 100, max_files_per_trigger: int = 1) -> DataFrame:
    """Run the stream over the Parquet files under ``src`` (available now) and return the histogram.

    The aggregate is the batch form's own, so both treat missing scores and
    labels alike.  Each micro-batch writes the complete histogram to a folder
    of its number (a replay writes the same rows there again), so the last
    whole one is never overwritten while it is the only copy.
    """
    scored = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(src)
    last: list[int] = []

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        last[:] = [batch_id]

    q = (roc_histogram(scored, keys, steps=steps).writeStream.outputMode("complete")
         .option("checkpointLocation", checkpoint).foreachBatch(publish)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if last:
        return spark.read.parquet(f"{out}/batch={last[0]}")
    done = spark.read.parquet(out)  # nothing new since an earlier run
    newest = done.agg(F.max("batch")).first()[0]
    return done.where(F.col("batch") == newest).drop("batch")
