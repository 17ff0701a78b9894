"""Alignment of features with label sets by record id.

The reference zips rows positionally (and in Python by raw directory listing
order of each folder).  Here every alignment is an equi-join on the record
id, and ``alignment_audit`` reports what a positional zip would have hidden.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def align(features: DataFrame, labels: DataFrame, id_col: str = "record_id", how: str = "inner") -> DataFrame:
    """Pair features with labels by record id."""
    return features.join(labels, id_col, how)


def align_many(features: DataFrame, labels: Mapping[str, DataFrame], id_col: str = "record_id") -> DataFrame:
    """One feature set and several label sets, in declared task order.

    Every join shares one key, so Catalyst plans one shuffle of the feature
    side; label tables are narrow and AQE broadcasts those that turn out small.
    """
    out = features
    for _task, lab in labels.items():
        out = out.join(lab, id_col, "inner")
    return out


def align_landed(features: DataFrame, labels: Mapping[str, DataFrame], id_col: str = "record_id") -> DataFrame:
    """J2 over tables landed by id (``sources.store.land``) in the same number of buckets.

    Every bucket of every table is there already, so the joins read bucket by
    bucket and no row is shuffled or broadcast, whatever the sizes.
    """
    out = features
    for lab in labels.values():
        out = out.join(lab.hint("merge"), id_col, "inner")
    return out


def alignment_audit(features: DataFrame, labels: Mapping[str, DataFrame], id_col: str = "record_id") -> DataFrame:
    """Per label set, ids matched, missing on either side, and duplicated.

    Ids are counted per side first (partial + final aggregate), so a duplicated
    id costs one row, never a join blow-up.
    """
    f = features.groupBy(id_col).agg(F.count(F.lit(1)).alias("__nf"))
    rows = None
    for task, lab in labels.items():
        lc = lab.groupBy(id_col).agg(F.count(F.lit(1)).alias("__nl"))
        j = f.join(lc, id_col, "full_outer")
        r = j.agg(
            F.count(F.when(F.col("__nf").isNotNull() & F.col("__nl").isNotNull(), 1)).alias("matched"),
            F.count(F.when(F.col("__nl").isNull(), 1)).alias("missing_labels"),
            F.count(F.when(F.col("__nf").isNull(), 1)).alias("missing_features"),
            F.count(F.when(F.col("__nf") > 1, 1)).alias("dup_feature_ids"),
            F.count(F.when(F.col("__nl") > 1, 1)).alias("dup_label_ids"),
        ).select(F.lit(task).alias("label_set"), "*")
        rows = r if rows is None else rows.unionByName(r)
    return rows


def attach_predictions(scored: DataFrame, labels: DataFrame, id_col: str = "record_id") -> DataFrame:
    """Pair each prediction with its label when they are stored apart."""
    return scored.join(labels, id_col, "inner")
