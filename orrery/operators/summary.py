"""Data set summaries, model selection, first records and row stacking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dataset_summary(df: DataFrame, features: str, targets: Sequence[str], id_col: str = "record_id") -> DataFrame:
    """A10: shape, first record with its features and labels, number of target sets, class counts.

    One row per (target set, class) with the data set's row count, vector
    widths and first record beside it.  All counts come from one scan: a row a
    target set, grouped (partial + final); the sums over classes run on that
    small table.  The first record is a top-1 by id.
    """
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("target_set"), F.col(t).cast("int").alias("class"))
                               for t in targets])).alias("t")
    counts = df.select(F.size(features).alias("__w"), each).groupBy("t.target_set", "t.class").agg(
        F.count(F.lit(1)).alias("n_class"), F.min("__w").alias("__lo"), F.max("__w").alias("__hi"))
    # One row a target set and class: the window is bounded by the classes.
    w, of = Window.partitionBy(F.lit(1)), Window.partitionBy("target_set")
    counts = counts.select("target_set", "class", "n_class", F.lit(len(targets)).alias("n_target_sets"),
                           F.sum("n_class").over(of).alias("n_rows"), F.min("__lo").over(w).alias("min_width"),
                           F.max("__hi").over(w).alias("max_width"))
    labels = F.map_from_arrays(F.array(*[F.lit(t) for t in targets]), F.array(*[F.col(t).cast("int") for t in targets]))
    first = first_records(df, 1, id_col).select(F.col(id_col).cast("long").alias("first_record"),
                                                F.col(features).alias("first_features"), labels.alias("__labels"))
    return counts.join(F.broadcast(first), F.lit(True), "left").select(  # one row
        *counts.columns, "first_record", F.col("__labels")[F.col("target_set")].alias("first_label"), "first_features")


def best_epoch(metrics: DataFrame, keys: Sequence[str], epoch: str | Sequence[str] = "epoch",
               split: str = "split", auc_col: str = "auc", select_on: str = "valid",
               report: str = "test") -> DataFrame:
    """The epoch (or any candidate, e.g. (config, epoch)) with the best validation AUC, never chosen on test.

    Ties go to the lowest candidate.  Returns the chosen candidate columns
    (``best_<name>``), its validation AUC and the reported (test) AUC of the
    same candidate.  One grouped ``max_by`` per key: no window, no sort.
    """
    cand = [epoch] if isinstance(epoch, str) else list(epoch)
    v = metrics.where(F.col(split) == select_on).where(F.col(auc_col).isNotNull())
    order = F.struct(F.col(auc_col), *[(-F.col(c)).alias(f"neg_{c}") for c in cand])
    best = v.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in cand]), order).alias("__best"),
                                F.max(auc_col).alias("valid_auc"))
    best = best.select(*keys, *[F.col(f"__best.{c}").alias(f"best_{c}") for c in cand], "valid_auc")
    rep = metrics.where(F.col(split) == report).select(*keys, *[F.col(c).alias(f"best_{c}") for c in cand],
                                                        F.col(auc_col).alias("test_auc"))
    return best.join(rep, [*keys, *[f"best_{c}" for c in cand]], "left")


def first_records(df: DataFrame, n: int, id_col: str = "record_id") -> DataFrame:
    """L1: the first n records in id order (a top-k: TakeOrderedAndProject)."""
    return df.orderBy(id_col).limit(n)


def stack_rows(*dfs: DataFrame) -> DataFrame:
    """Stack data sets row-wise by column name (UNION ALL)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out
