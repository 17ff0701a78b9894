"""ROC AUC as grouped aggregation.

Input is a *scored* long table: one row per (record, group) with a 0/1 label
``y`` and a score ``p``; the group keys are free (split, task, class, epoch,
...).  Multiclass arrays are first expanded to one-vs-rest rows by
``expand_classes``.

* exact AUC (Mann-Whitney, ties count half) pre-aggregates to one row per
  distinct score, then needs "negatives strictly below" each score: an
  ordered running sum, done with the two-level prefix sum so no group, however
  large, lands in one task;
* binned AUC (T thresholds, the reference's evaluation) reduces every group to
  at most T+1 histogram rows before any window runs.

All sums run in double precision: pos x neg products overflow 64-bit integers
long before 100 TB.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scan import prefix_sums


def expand_classes(scored: DataFrame, y: str = "y", p: str = "p", cls: str = "class") -> DataFrame:
    """One-vs-rest rows for a multiclass score array (A6 input).

    ``y`` is the class index, ``p`` an array of class scores; the output has
    ``cls`` (0-based position), ``y`` = 1 when the record is of that class and
    ``p`` = that class's score.
    """
    others = [c for c in scored.columns if c not in (y, p)]
    return (scored.select(*others, F.col(y).alias("__y"), F.posexplode(p).alias(cls, "__p"))
            .select(*others, F.col(cls).cast("int").alias(cls),
                    (F.col("__y") == F.col(cls)).cast("int").alias(y), F.col("__p").alias(p)))


def _valid(scored: DataFrame, y: str, p: str) -> DataFrame:
    """Rows with both a label and a score (NaN is none); labels other than 0/1 count as neither class."""
    return scored.where(F.col(y).isNotNull() & F.col(p).isNotNull() & ~F.isnan(F.col(p).cast("double")))


def score_counts(scored: DataFrame, keys: Sequence[str], y: str = "y", p: str = "p") -> DataFrame:
    """Positives and negatives per distinct score (partial + final hash aggregate)."""
    return _valid(scored, y, p).groupBy(*keys, p).agg(
        F.sum((F.col(y) == 1).cast("double")).alias("pos"),
        F.sum((F.col(y) == 0).cast("double")).alias("neg"))


def negatives_below(scored: DataFrame, keys: Sequence[str], y: str = "y", p: str = "p",
                    num_partitions: int | None = None) -> DataFrame:
    """For each distinct score, negatives strictly below it in its group."""
    counts = score_counts(scored, keys, y, p)
    out = prefix_sums(counts, keys, [p], ["neg"], suffix="_below", num_partitions=num_partitions)
    return out


def auc_exact(scored: DataFrame, keys: Sequence[str], y: str = "y", p: str = "p",
              num_partitions: int | None = None) -> DataFrame:
    """A5: exact rank AUC per group; NULL when a group lacks either class."""
    nb = negatives_below(scored, keys, y, p, num_partitions)
    agg = nb.groupBy(*keys).agg(
        F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2)).alias("__num"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return agg.select(*keys,
                      F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                             F.col("__num") / (F.col("n_pos") * F.col("n_neg"))).alias("auc"),
                      F.col("n_pos").cast("long").alias("n_pos"), F.col("n_neg").cast("long").alias("n_neg"))


def score_bin(p, steps: int = 100):
    """Threshold bin of a probability: the largest k with p >= k/steps.

    The inner round removes binary noise (0.29*100 = 28.999...); scores are
    clamped to [0, 1].
    """
    b = F.floor(F.round(F.col(p) * F.lit(float(steps)), 9))
    return F.least(F.greatest(b, F.lit(0)), F.lit(steps)).cast("int")


def roc_histogram(scored: DataFrame, keys: Sequence[str], y: str = "y", p: str = "p",
                  steps: int = 100) -> DataFrame:
    """A3: mergeable ROC state, positives and negatives per threshold bin (<= steps+1 rows a group)."""
    return (_valid(scored, y, p).groupBy(*keys, score_bin(p, steps).alias("bin"))
            .agg(F.sum((F.col(y) == 1).cast("long")).alias("pos"),
                 F.sum((F.col(y) == 0).cast("long")).alias("neg")))


def merge_histograms(*hists: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Union of partial histograms, summed: equal to the histogram of the union."""
    u = hists[0]
    for h in hists[1:]:
        u = u.unionByName(h)
    return u.groupBy(*keys, "bin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def roc_curve(hist: DataFrame, keys: Sequence[str], steps: int = 100) -> DataFrame:
    """ROC points by descending threshold with the previous point (lag).

    Windows run over the histogram, at most steps+1 rows a group.
    """
    w = Window.partitionBy(*keys).orderBy(F.col("bin").desc())
    w_all = Window.partitionBy(*keys)
    cum = hist.select(*keys, "bin",
                      F.sum("pos").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("tp"),
                      F.sum("neg").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("fp"),
                      F.sum("pos").over(w_all).alias("n_pos"),
                      F.sum("neg").over(w_all).alias("n_neg"))
    return cum.select(*keys, "bin",
                      (F.col("bin") / F.lit(float(steps))).alias("threshold"),
                      "tp", "fp",
                      F.lag("tp", 1, 0).over(w).alias("tp_prev"),
                      F.lag("fp", 1, 0).over(w).alias("fp_prev"),
                      "n_pos", "n_neg")


def auc_binned(hist: DataFrame, keys: Sequence[str], steps: int = 100) -> DataFrame:
    """A4: trapezoid area under the binned ROC curve, from (0,0) to (1,1)."""
    cur = roc_curve(hist, keys, steps)
    area = (F.col("fp") - F.col("fp_prev")).cast("double") * (F.col("tp") + F.col("tp_prev")).cast("double") / 2
    agg = cur.groupBy(*keys).agg(F.sum(area).alias("__a"),
                                 F.max("n_pos").alias("n_pos"), F.max("n_neg").alias("n_neg"))
    return agg.select(*keys,
                      F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                             F.col("__a") / (F.col("n_pos").cast("double") * F.col("n_neg"))).alias("auc"),
                      F.col("n_pos").cast("long").alias("n_pos"), F.col("n_neg").cast("long").alias("n_neg"))


def auc(scored: DataFrame, keys: Sequence[str], method: str = "exact", steps: int = 100,
        y: str = "y", p: str = "p") -> DataFrame:
    if method == "exact":
        return auc_exact(scored, keys, y, p)
    if method == "binned":
        return auc_binned(roc_histogram(scored, keys, y, p, steps), keys, steps)
    raise ValueError(f"unknown AUC method {method!r}")


def auc_per_class(scored: DataFrame, keys: Sequence[str], method: str = "exact", steps: int = 100,
                  y: str = "y", p: str = "p", cls: str = "class") -> DataFrame:
    """One-vs-rest AUC of every class of a multiclass score array."""
    return auc(expand_classes(scored, y, p, cls), [*keys, cls], method, steps, y, p)


def auc_macro(per_class: DataFrame, keys: Sequence[str], auc_col: str = "auc") -> DataFrame:
    """Unweighted mean over classes with a defined AUC, and how many were defined."""
    return per_class.groupBy(*keys).agg(F.avg(auc_col).alias("auc_macro"),
                                        F.count(auc_col).alias("n_classes"))


def auc_task_mean(per_task: DataFrame, keys: Sequence[str], task: str = "task", task_no: str = "task_no",
                  auc_col: str = "auc") -> DataFrame:
    """Mean over tasks, beside the per-task list in declared task order."""
    return per_task.groupBy(*keys).agg(
        F.avg(auc_col).alias("auc_mean"),
        F.count(auc_col).alias("n_tasks"),
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(task_no), F.col(task), F.col(auc_col)))),
                    lambda s: F.struct(s[task].alias(task), s[auc_col].alias(auc_col))).alias("per_task"))
