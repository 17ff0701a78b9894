"""Exact running sums inside groups, without putting a group in one task.

``Window.partitionBy(group).orderBy(x)`` sends a whole group to one task; a
group holding a third of a 100 TB table would not survive that.  The form
used here is the classic two-level prefix sum:

1. range-partition rows on ``(group keys, order keys)``: every partition is a
   contiguous key range of about N/P rows, however the groups are sized;
2. per (partition, group) totals: at most P + G - 1 rows, hash aggregated;
3. the offset of each (partition, group) is the sum of the totals of the
   same group in earlier partitions: a window over at most P rows per group.
   Only groups that cross a partition border get a nonzero offset, and each
   border is crossed by at most one group, so the offsets table has at most
   P - 1 rows: a broadcast with a proven size bound;
4. a local window over (partition, group) plus the offset.

Steps 2 and 4 both read the range-partitioned rows, so they are checkpointed
once: the partition of a row must be the same in both passes.

The order keys must be unique within a group (add a tie-breaker column), so
the result does not depend on partitioning.  Null group values form a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root

_PID = "__pid"


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def prefix_sums(df: DataFrame, by: Sequence[str], order: Sequence[str], values: Sequence[str],
                inclusive: bool = False, suffix: str = "_before",
                num_partitions: int | None = None) -> DataFrame:
    """Add ``<value><suffix>`` = sum of ``value`` over earlier rows of the group.

    ``inclusive=True`` includes the current row (a running total).
    """
    by, order, values = list(by), list(order), list(values)
    spark = df.sparkSession
    checkpoint_root(spark)
    # Both passes below must see the same partition of every row.  Range
    # bounds are sampled from the input, and input arriving from a shuffle has
    # no fixed row order, so two evaluations could disagree; a reliable
    # checkpoint fixes the partitioning once (and cuts the lineage).
    # Without an explicit count, AQE sizes the range partitions from the data
    # (adjacent ranges are coalesced, so each partition stays one contiguous range).
    ranged = (df.repartitionByRange(*([num_partitions] if num_partitions else []), *_cols(by + order))
              .checkpoint(eager=True)
              .withColumn(_PID, F.spark_partition_id()))

    totals = ranged.groupBy(_PID, *by).agg(*[F.sum(v).alias(v) for v in values])
    w_prev = Window.partitionBy(*by).orderBy(_PID)
    offsets = (totals
               .select(_PID, *by,
                       F.row_number().over(w_prev).alias("__k"),
                       *[F.sum(v).over(w_prev.rowsBetween(Window.unboundedPreceding, -1)).alias(f"__off_{v}")
                         for v in values])
               .where(F.col("__k") > 1)          # groups continued from an earlier partition: <= P-1 rows
               .drop("__k"))

    end = Window.currentRow if inclusive else -1
    w_loc = Window.partitionBy(_PID, *by).orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, end)
    local = ranged.select("*", *[F.sum(v).over(w_loc).alias(f"__loc_{v}") for v in values])
    # A null group value is a group like any other, so its offsets must match too.
    offsets = offsets.withColumnsRenamed({c: f"__of_{c}" for c in [_PID, *by]})
    same = F.col(_PID) == F.col(f"__of_{_PID}")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    out = local.join(F.broadcast(offsets), same, "left")
    zero = F.lit(0)
    return out.select(*[F.col(c) for c in df.columns],
                      *[(F.coalesce(F.col(f"__off_{v}"), zero) + F.coalesce(F.col(f"__loc_{v}"), zero))
                        .alias(f"{v}{suffix}") for v in values])


def row_number_within(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    """1-based position of each row in its group by ``order`` (unique within group)."""
    tmp = "__one"
    out = prefix_sums(df.withColumn(tmp, F.lit(1).cast("long")), by, order, [tmp], inclusive=True,
                      suffix="_rn", num_partitions=num_partitions)
    return out.drop(tmp).withColumnRenamed(tmp + "_rn", name)
