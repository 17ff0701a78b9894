"""Batch scoring and evaluation (V1-V4).

``predict`` runs the network's forward pass per Arrow batch on executors with
the weights broadcast once; everything after it (one-vs-rest expansion, ROC
histograms, AUC, losses) is DataFrame aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import nn
from ..operators import auc as au
from ..operators.encode import one_hot
from ..session import ship_package
from .net import Head, NetSpec, forward


def arrow_matrix(col: pa.Array, width: int) -> np.ndarray:
    """A fixed-width list<double> Arrow column as an (n, width) float64 matrix; other rows are refused."""
    if col.null_count:
        raise ValueError("a feature vector is null")
    lens = np.diff(col.offsets.to_numpy())
    if (lens != width).any():
        raise ValueError(f"a feature vector has {lens[lens != width][0]} values, not {width}")
    if col.flatten().null_count or not np.isfinite(col.flatten().to_numpy(zero_copy_only=False)).all():
        raise ValueError("a feature is null or not finite")
    vals = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return vals.reshape(-1, width)


def predict(df: DataFrame, spec: NetSpec, theta: np.ndarray, features: str = "features",
            keep: Sequence[str] | None = None) -> DataFrame:
    """V1: add ``p_<task>`` per head: a probability for binary heads, a probability array otherwise.

    ``keep`` columns pass through (default: all but the features).
    """
    spark = df.sparkSession
    ship_package(spark)
    keep = [c for c in (keep if keep is not None else df.columns) if c != features]
    in_df = df.select(*keep, F.col(features).cast("array<double>").alias("__x"))
    bc = spark.sparkContext.broadcast((spec.to_json(), theta))
    fields = [f for f in in_df.schema.fields if f.name != "__x"]
    out_fields = list(fields)
    for h in spec.heads:
        out_fields.append(T.StructField(f"p_{h.task}", T.DoubleType() if h.n == 1 else
                                        T.ArrayType(T.DoubleType(), False), True))
    out_schema = T.StructType(out_fields)
    width = spec.n_in

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        spec_json, th = bc.value
        sp = NetSpec.from_json(spec_json)
        schema = to_arrow_schema(out_schema)
        for b in batches:
            if b.num_rows == 0:
                continue
            X = arrow_matrix(b.column("__x"), width)
            probs = forward(sp, th, X)
            cols = [b.column(f.name) for f in fields]
            for h in sp.heads:
                p = probs[h.task]
                if h.n == 1:
                    cols.append(pa.array(p, type=pa.float64()))
                else:
                    offsets = pa.array(np.arange(0, p.size + 1, h.n, dtype=np.int32))
                    cols.append(pa.ListArray.from_arrays(offsets, pa.array(p.ravel(), type=pa.float64())))
            yield pa.RecordBatch.from_arrays(cols, schema=schema)

    return in_df.mapInArrow(run, out_schema)


def scored_long(pred: DataFrame, spec: NetSpec, keys: Sequence[str] = ("split",)) -> DataFrame:
    """(keys..., task, class, y, p): binary heads give class 0, softmax heads one row per class."""
    keys = list(keys)
    parts = []
    for h in spec.heads:
        base = pred.where(F.col(h.label).isNotNull())
        if h.n == 1:
            parts.append(base.select(*keys, F.lit(h.task).alias("task"), F.lit(0).alias("class"),
                                     F.col(h.label).cast("int").alias("y"), F.col(f"p_{h.task}").alias("p")))
        else:
            e = au.expand_classes(base.select(*keys, F.lit(h.task).alias("task"),
                                              F.col(h.label).cast("int").alias("y"),
                                              F.col(f"p_{h.task}").alias("p")))
            parts.append(e.select(*keys, "task", "class", "y", "p"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def task_losses(pred: DataFrame, spec: NetSpec, keys: Sequence[str] = ("split",)) -> DataFrame:
    """Mean loss per (keys, task), rows with a label only."""
    keys = list(keys)
    parts = []
    for h in spec.heads:
        y = F.col(h.label)
        loss = nn.bce(y, f"p_{h.task}") if h.n == 1 else nn.cce(one_hot(y.cast("int"), h.n), f"p_{h.task}")
        parts.append(pred.where(y.isNotNull()).groupBy(*keys).agg(
            F.avg(loss).alias("loss"), F.count(F.lit(1)).alias("rows")).withColumn("task", F.lit(h.task)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def evaluate(pred: DataFrame, spec: NetSpec, keys: Sequence[str] = ("split",), method: str = "binned",
             steps: int = 100) -> DataFrame:
    """V2: AUC per (keys, task) -- binary plain, multiclass macro over classes -- with loss and rows.

    All splits and tasks are grouping keys of one plan.
    """
    keys = list(keys)
    long = scored_long(pred, spec, keys)
    per_class = au.auc(long, [*keys, "task", "class"], method=method, steps=steps)
    macro = au.auc_macro(per_class, [*keys, "task"])
    return (macro.join(task_losses(pred, spec, keys), [*keys, "task"], "left")
            .select(*keys, "task", F.col("auc_macro").alias("auc"), "n_classes", "loss", "rows"))


def _class_rows(h: Head) -> Column:
    """(task, class, y, p) of one prediction, a row for each class of the head; none without a label."""
    y, p = F.col(h.label).cast("int"), F.col(f"p_{h.task}")

    def row(c: Column, hit: Column, x: Column) -> Column:
        return F.struct(F.lit(h.task).alias("task"), c.cast("int").alias("class"), hit.cast("int").alias("y"), x.alias("p"))

    each = F.array(row(F.lit(0), y, p)) if h.n == 1 else F.transform(p, lambda x, c: row(c, y == c, x))
    return F.filter(each, lambda _: y.isNotNull())


def report(pred: DataFrame, spec: NetSpec, keys: Sequence[str] = ("split",), steps: int = 100) -> DataFrame:
    """V4: exact and binned AUC, loss and rows per (keys, task), from one pass over the predictions.

    Every prediction becomes one row a head and class (one Expand), and those
    one row for each distinct score.  Exact numerators, threshold bins and
    losses are all functions of such rows, so they leave the one aggregate per
    bin that follows the prefix sum: at most ``steps + 1`` rows a group.
    """
    keys = list(keys)
    rows = F.concat(*[_class_rows(h) for h in spec.heads])
    long = pred.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")
    group = [*keys, "task", "class"]
    scores = au.negatives_below(long, group)
    binary = F.col("task").isin([h.task for h in spec.heads if h.n == 1])
    p = nn.clip_prob("p")
    loss = -(F.col("pos") * F.ln(p)) - F.when(binary, F.col("neg") * F.ln(1.0 - p)).otherwise(0.0)
    bins = scores.groupBy(*group, au.score_bin("p", steps).alias("bin")).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum(loss).alias("loss"),
        F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2)).alias("exact"))
    higher = Window.partitionBy(*group).orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("tp", F.coalesce(F.sum("pos").over(higher), F.lit(0.0)))
    per_class = bins.groupBy(*group).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("loss").alias("loss"), F.sum("exact").alias("exact"),
        F.sum(F.col("neg") * (F.col("tp") + F.col("pos") / 2)).alias("binned"))
    pairs = F.when((F.col("pos") > 0) & (F.col("neg") > 0), F.col("pos") * F.col("neg"))
    labelled = F.col("pos") + F.when(binary, F.col("neg")).otherwise(0.0)  # a record is positive in one class of its head
    out = per_class.groupBy(*keys, "task").agg(
        F.avg(F.col("exact") / pairs).alias("auc_exact"), F.avg(F.col("binned") / pairs).alias("auc_binned"),
        F.count(pairs).alias("n_classes"), F.sum("loss").alias("loss"), F.sum(labelled).alias("rows"))
    return out.select(*keys, "task", "auc_exact", "auc_binned", "n_classes", (F.col("loss") / F.col("rows")).alias("loss"),
                      F.col("rows").cast("long").alias("rows"))


def trapezoid_auc(bins_pos_neg: list[tuple[int, int, int]]) -> float | None:
    """Binned AUC from one group's histogram rows (bin, pos, neg): the same
    trapezoid as ``auc_binned``, for a collected (<= steps+1 rows) histogram."""
    rows = sorted(bins_pos_neg, key=lambda r: -r[0])
    n1 = sum(r[1] for r in rows)
    n0 = sum(r[2] for r in rows)
    if n1 == 0 or n0 == 0:
        return None
    tp = fp = 0
    area = 0.0
    for _, pos, neg in rows:
        area += neg * (2 * tp + pos) / 2.0
        tp += pos
        fp += neg
    return area / (n1 * n0)
