"""Registered queries: one per operator of the inventory, over whole tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame whose columns
are aliased exactly as in the matching oracle SQL (``oracle.py``).  Doubles
are rounded to 6 places at the very end, after all aggregation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import nn
from ..operators import align as al
from ..operators import auc as au
from ..operators import split as sp
from ..session import ship_package
from .tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    """Register a query; the registered callable first ships this package to the executors."""
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        run.__name__ = run.__qualname__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------- shared plans

def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents x labels by doc_id, 80/10/10 split by id, fixed length score.

    The id space of the split is the record table (documents), as record
    numbers define it, not whichever records happen to have labels.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labs = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    j = al.align(docs, labs, id_col="doc_id")
    j = sp.assign_split(j, "doc_id", 0.8, 0.1, id_space=docs)
    return j.withColumn("p", nn.length_score("n_chars"))


def doc_scored_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, split, task, y, p) for the two binary tasks."""
    d = labelled_documents(spark, sf_dir)
    return d.select("doc_id", "split", "p",
                    F.explode(F.array(
                        F.struct(F.lit("quality").alias("task"), F.col("quality").alias("y")),
                        F.struct(F.lit("toxic").alias("task"), F.col("toxic").alias("y")))).alias("t")
                    ).select("doc_id", "split", F.col("t.task").alias("task"), F.col("t.y").alias("y"), "p")


# ---------------------------------------------------------------- flagship

@register("v2_evaluate")
def q_v2_evaluate(spark, sf_dir):
    """V2 flagship: exact and binned AUC of every split and task in one job."""
    s = doc_scored_long(spark, sf_dir)
    keys = ["split", "task"]
    ex = au.auc_exact(s, keys)
    bn = au.auc_binned(au.roc_histogram(s, keys), keys).select(*keys, F.col("auc").alias("auc_binned"))
    return (ex.join(bn, keys)
            .select("split", "task", r6("auc").alias("auc_exact"), r6("auc_binned").alias("auc_binned"),
                    "n_pos", "n_neg"))


# ---------------------------------------------------------------- AUC family

@register("a3_roc_histogram")
def q_a3(spark, sf_dir):
    return au.roc_histogram(doc_scored_long(spark, sf_dir), ["split", "task"])


@register("w1_roc_curve")
def q_w1(spark, sf_dir):
    h = au.roc_histogram(doc_scored_long(spark, sf_dir), ["split", "task"])
    c = au.roc_curve(h, ["split", "task"])
    return c.select("split", "task", "bin", r6("threshold").alias("threshold"), "tp", "fp", "tp_prev", "fp_prev")


@register("a4_auc_binned")
def q_a4(spark, sf_dir):
    s = doc_scored_long(spark, sf_dir)
    a = au.auc_binned(au.roc_histogram(s, ["split", "task"]), ["split", "task"])
    return a.select("split", "task", r6("auc").alias("auc"), "n_pos", "n_neg")


@register("a5_auc_exact")
def q_a5(spark, sf_dir):
    a = au.auc_exact(doc_scored_long(spark, sf_dir), ["split", "task"])
    return a.select("split", "task", r6("auc").alias("auc"), "n_pos", "n_neg")


@register("w2_negatives_below")
def q_w2(spark, sf_dir):
    nb = au.negatives_below(doc_scored_long(spark, sf_dir), ["split", "task"])
    return nb.select("split", "task", r6("p").alias("p"), F.col("pos").cast("long").alias("pos"),
                     F.col("neg").cast("long").alias("neg"), F.col("neg_below").cast("long").alias("neg_below"))


def class_map(n_in: int = 64, n_out: int = 10) -> list[list[float]]:
    """Fixed linear map of a whole vector to class scores, by a rule."""
    return [[((i * (c + 2) + 3 * c) % 7 - 3) / 4 for i in range(n_in)] for c in range(n_out)]


def embedding_scored(spark, sf_dir) -> DataFrame:
    """(vec_id, split, y = label, p = softmax of a fixed linear map of the whole embedding)."""
    e = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("label").alias("y"),
        nn.softmax(nn.dense(F.col("embedding").cast("array<double>"), class_map(), [0.0] * 10)).alias("p"))
    return sp.assign_split(e, "vec_id", 0.8, 0.1)


@register("a6_auc_per_class")
def q_a6(spark, sf_dir):
    a = au.auc_per_class(embedding_scored(spark, sf_dir).drop("vec_id"), ["split"])
    return a.select("split", "class", r6("auc").alias("auc"), "n_pos", "n_neg")


@register("a7_auc_macro")
def q_a7(spark, sf_dir):
    pc = au.auc_per_class(embedding_scored(spark, sf_dir).drop("vec_id"), ["split"])
    m = au.auc_macro(pc, ["split"])
    return m.select("split", r6("auc_macro").alias("auc_macro"), "n_classes")


@register("a8_auc_task_mean")
def q_a8(spark, sf_dir):
    s = doc_scored_long(spark, sf_dir)
    per_task = au.auc_exact(s, ["split", "task"]).withColumn(
        "task_no", F.when(F.col("task") == "quality", 0).otherwise(1))
    m = au.auc_task_mean(per_task, ["split"])
    return m.select("split", r6("auc_mean").alias("auc_mean"), "n_tasks",
                    r6(F.col("per_task")[0]["auc"]).alias("auc_quality"),
                    r6(F.col("per_task")[1]["auc"]).alias("auc_toxic"))


@register("a9_mean_loss")
def q_a9(spark, sf_dir):
    s = doc_scored_long(spark, sf_dir).withColumn("loss", nn.bce("y", "p"))
    per = s.groupBy("split", "task").agg(F.avg("loss").alias("loss"))
    total = per.groupBy("split").agg(F.sum("loss").alias("loss")).select("split", F.lit("all").alias("task"), "loss")
    return per.unionByName(total).select("split", "task", r6("loss").alias("mean_loss"))


def epoch_scored(spark, sf_dir, epochs: int = 5) -> DataFrame:
    """Scores of a family of 'epochs' on documents: length score plus an epoch-dependent,
    id-derived perturbation.  Stands in for per-epoch model outputs."""
    d = labelled_documents(spark, sf_dir)
    ep = F.explode(F.sequence(F.lit(1), F.lit(epochs))).alias("epoch")
    d = d.select("*", ep)
    noise = ((F.col("doc_id") * 7919 + F.col("epoch") * 104729) % 1000).cast("double") / 1000.0 - 0.5
    p = nn.sigmoid_scalar(F.col("n_chars").cast("double") / 1000.0 - 2.0 + noise * F.col("epoch"))
    return d.select("doc_id", "epoch", "split", "quality", "toxic", p.alias("p")).select(
        "doc_id", "epoch", "split", "p",
        F.explode(F.array(F.struct(F.lit("quality").alias("task"), F.col("quality").alias("y")),
                          F.struct(F.lit("toxic").alias("task"), F.col("toxic").alias("y")))).alias("t")
    ).select("doc_id", "epoch", "split", F.col("t.task").alias("task"), F.col("t.y").alias("y"), "p")


@register("a11_best_epoch")
def q_a11(spark, sf_dir):
    from ..operators.summary import best_epoch
    metrics = au.auc_exact(epoch_scored(spark, sf_dir), ["epoch", "split", "task"])
    b = best_epoch(metrics, ["task"])
    return b.select("task", "best_epoch", r6("valid_auc").alias("valid_auc"), r6("test_auc").alias("test_auc"))


# ---------------------------------------------------------------- splits, batches, slices

def _orders_slices(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("record_id"), "o_totalprice")
    return [("train", sp.slice_records(o, None, sp.NB_TRAIN)),
            ("valid", sp.slice_records(o, sp.NB_TRAIN, sp.NB_TRAIN + sp.NB_VALID)),
            ("test", sp.slice_records(o, sp.NB_TRAIN + sp.NB_VALID, None))]


@register("p1_slice_records")
def q_p1(spark, sf_dir):
    from ..operators.summary import stack_rows
    parts = [df.withColumn("slice", F.lit(name)) for name, df in _orders_slices(spark, sf_dir)]
    return stack_rows(*parts).groupBy("slice").agg(
        F.count(F.lit(1)).alias("n"), F.min("record_id").alias("min_id"), F.max("record_id").alias("max_id"))


@register("u1_stack_rows")
def q_u1(spark, sf_dir):
    from ..operators.summary import stack_rows
    parts = [df.withColumn("slice", F.lit(name)) for name, df in _orders_slices(spark, sf_dir)]
    return stack_rows(*parts).select("record_id", "slice", r6("o_totalprice").alias("o_totalprice"))


@register("p2_assign_split")
def q_p2(spark, sf_dir):
    return labelled_documents(spark, sf_dir).select("doc_id", "split")


@register("w3_batch_number")
def q_w3(spark, sf_dir):
    d = labelled_documents(spark, sf_dir).select("doc_id", "split")
    return sp.batch_number(d, ["split"], id_col="doc_id")


@register("l1_first_records")
def q_l1(spark, sf_dir):
    from ..operators.summary import first_records
    d = labelled_documents(spark, sf_dir).select("doc_id", "n_chars", "quality", "toxic")
    return first_records(d, 10, id_col="doc_id")


# ---------------------------------------------------------------- projections

@register("p3_assemble_features")
def q_p3(spark, sf_dir):
    from .cohort import cohort_features
    f = cohort_features(spark, sf_dir)
    return f.select("record_id", F.posexplode("features").alias("pos", "value")).select(
        "record_id", F.col("pos").cast("int").alias("pos"), r6("value").alias("value"))


@register("p4_squeeze_label")
def q_p4(spark, sf_dir):
    from ..operators.features import squeeze_label
    lab = table(spark, sf_dir, "labels").select(
        "doc_id", F.array("quality").alias("one"), F.array("quality", "toxic").alias("two"))
    both = lab.select("doc_id", squeeze_label("one", 1).alias("quality"), squeeze_label("two", 2).alias("two"))
    return both.select("doc_id", "quality", F.col("two")[0].alias("two_0"), F.col("two")[1].alias("two_1"),
                       F.size("two").alias("two_width"))


@register("p5_select_groups")
def q_p5(spark, sf_dir):
    from ..operators.features import select_group
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    groups = F.array(*[F.struct(F.lit(g).alias("grp"), select_group("x", g, 8).alias("v")) for g in range(8)])
    return (e.select("vec_id", F.explode(groups).alias("g"))
            .select("vec_id", F.col("g.grp").alias("grp"), F.posexplode("g.v").alias("i", "value"))
            .select("vec_id", "grp", F.col("i").cast("int").alias("i"), r6("value").alias("value")))


# ---------------------------------------------------------------- alignment

@register("j1_align")
def q_j1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labs = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return al.align(docs, labs, id_col="doc_id")


@register("j2_align_many")
def q_j2(spark, sf_dir):
    from .cohort import cohort_labels
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("record_id"), "o_totalprice")
    j = al.align_many(orders, cohort_labels(spark, sf_dir))
    return j.select("record_id", r6("o_totalprice").alias("o_totalprice"), "y_mortality", "y_los", "y_survival")


@register("j3_alignment_audit")
def q_j3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"))
    labs = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("record_id"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("record_id"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("record_id"))
    a = al.alignment_audit(docs, {"labels": labs})
    b = al.alignment_audit(orders, {"lineitem": lines})
    return a.unionByName(b)


@register("j4_attach_predictions")
def q_j4(spark, sf_dir):
    preds = table(spark, sf_dir, "documents").select("doc_id", nn.length_score("n_chars").alias("p"))
    labs = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    j = al.attach_predictions(preds, labs, id_col="doc_id")
    return j.select("doc_id", r6("p").alias("p"), "quality", "toxic")


# ---------------------------------------------------------------- encodings

@register("e1_one_hot")
def q_e1(spark, sf_dir):
    from ..operators.encode import one_hot
    e = table(spark, sf_dir, "embeddings").select("vec_id", one_hot("label", 10).alias("oh"))
    return e.select("vec_id", *[F.col("oh")[i].alias(f"oh_{i}") for i in range(10)])


@register("e2_one_hot_nullable")
def q_e2(spark, sf_dir):
    from ..operators.encode import one_hot_nullable
    vals = ["en", "fr", "de"]
    d = table(spark, sf_dir, "documents").select("doc_id", one_hot_nullable("lang", vals).alias("oh"))
    return d.select("doc_id", *[F.col("oh")[i].alias(f"lang_{v}") for i, v in enumerate(vals)])


def _line_days(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return li.join(o, "l_orderkey").select(
        "l_orderkey", "l_linenumber",
        F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")).alias("days"))


@register("e3_los_bucket")
def q_e3(spark, sf_dir):
    from ..operators.encode import los_bucket
    return _line_days(spark, sf_dir).select("l_orderkey", "l_linenumber", "days", los_bucket("days").alias("los"))


@register("e4_survival_bucket")
def q_e4(spark, sf_dir):
    from ..operators.encode import survival_bucket
    return _line_days(spark, sf_dir).select("l_orderkey", "l_linenumber", "days",
                                           survival_bucket("days").alias("survival"))


@register("e5_activations")
def q_e5(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    a = e.select("vec_id", F.arrays_zip(
        F.col("x").alias("x"), nn.relu("x").alias("relu"), nn.sigmoid("x").alias("sigmoid"),
        nn.softmax("x").alias("softmax")).alias("z"))
    return (a.select("vec_id", F.posexplode("z").alias("i", "t"))
            .select("vec_id", F.col("i").cast("int").alias("i"), r6("t.relu").alias("relu"),
                    r6("t.sigmoid").alias("sigmoid"), r6("t.softmax").alias("softmax")))


@register("e6_bce")
def q_e6_bce(spark, sf_dir):
    s = doc_scored_long(spark, sf_dir)
    return s.select("doc_id", "task", r6(nn.bce("y", "p")).alias("loss"))


@register("e6_cce")
def q_e6_cce(spark, sf_dir):
    from ..operators.encode import one_hot
    s = embedding_scored(spark, sf_dir)
    return s.select("vec_id", r6(nn.cce(one_hot("y", 10), "p")).alias("loss"))


# ---------------------------------------------------------------- statistics (A1, A2, A10)

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def event_stats(spark, sf_dir):
    from ..operators.features import variable_stats
    ev = table(spark, sf_dir, "events")
    return variable_stats(ev, "user_id", "event_type", "ts", "value", tiebreak="event_id")


@register("a1_variable_stats")
def q_a1(spark, sf_dir):
    from ..operators.features import STATS
    s = event_stats(spark, sf_dir)
    return s.select("user_id", "event_type", "count", *[r6(c).alias(c) for c in STATS[1:]])


@register("a2_stats_wide")
def q_a2(spark, sf_dir):
    from ..operators.features import STATS, events_wide
    w = events_wide(table(spark, sf_dir, "events"), "user_id", "event_type", EVENT_TYPES, "ts", "value",
                    tiebreak="event_id")
    return w.select("user_id", *[(F.col(f"{v}_{s}") if s == "count" else r6(f"{v}_{s}")).alias(f"{v}_{s}")
                                 for v in EVENT_TYPES for s in STATS])


@register("a10_dataset_summary")
def q_a10(spark, sf_dir):
    """Shape, class counts, and the first record: its features and, beside each target set, its label."""
    from ..operators.summary import dataset_summary
    from .cohort import WIDTH
    # features x the three label sets (J2), stored once and shared with training
    data = cohort_prepared(spark, sf_dir)
    out = dataset_summary(data, "features", ["y_mortality", "y_los", "y_survival"])
    return out.select(*[c for c in out.columns if c != "first_features"],
                      *[r6(F.col("first_features")[i]).alias(f"first_f{i}") for i in range(WIDTH)])


# ---------------------------------------------------------------- sources

def _export_embeddings(spark, sf_dir) -> str:
    """embeddings -> one <vec_id>.csv per vector (64 doubles) in a fresh shared folder."""
    from ..session import scratch_path
    from ..sources.numbered import write_numbered_csv
    path = scratch_path(spark, "emb-csv")
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    write_numbered_csv(e, path, "vec_id", "x")
    return path


def _flat(df: DataFrame, col: str, width: int, prefix: str = "f") -> DataFrame:
    return df.select("record_id", *[r6(F.col(col)[i]).alias(f"{prefix}{i}") for i in range(width)])


@register("s1_read_numbered_csv")
def q_s1(spark, sf_dir):
    from ..sources.numbered import read_numbered_csv
    path = _export_embeddings(spark, sf_dir)
    return _flat(read_numbered_csv(spark, path, 64), "features", 64)


@register("s2_read_csv_dir")
def q_s2(spark, sf_dir):
    from ..session import scratch_path
    from ..sources.numbered import read_csv_dir, write_numbered_csv
    path = scratch_path(spark, "labels-csv")
    lab = table(spark, sf_dir, "labels").select("doc_id", F.array(F.col("quality").cast("double"),
                                                                  F.col("toxic").cast("double")).alias("y"))
    write_numbered_csv(lab, path, "doc_id", "y")
    return _flat(read_csv_dir(spark, path, 2, name="y"), "y", 2, prefix="c")


@register("s3_read_sequences")
def q_s3(spark, sf_dir):
    from ..session import scratch_path
    from ..sources.numbered import read_sequences, write_numbered_csv
    from .tables import hours
    path = scratch_path(spark, "events-seq")
    events = table(spark, sf_dir, "events")
    ev = events.select(
        "user_id", F.struct(F.col("ts"), F.col("event_id")).alias("o"),
        F.array(F.col("value"), hours(events, "ts")).alias("x"))
    write_numbered_csv(ev, path, "user_id", "x", header="value,hour", order_col="o")
    s = read_sequences(spark, path, 2)
    return s.select("record_id", "step", r6(F.col("x")[0]).alias("value"), r6(F.col("x")[1]).alias("hour"))


@register("s4_read_dataset")
def q_s4(spark, sf_dir):
    from ..session import scratch_path
    from ..sources.numbered import read_dataset, write_numbered_csv
    feat = _export_embeddings(spark, sf_dir)
    e = table(spark, sf_dir, "embeddings")
    lab_dir, high_dir = scratch_path(spark, "emb-label"), scratch_path(spark, "emb-high")
    write_numbered_csv(e.select("vec_id", F.array(F.col("label").cast("double")).alias("y")), lab_dir, "vec_id", "y")
    write_numbered_csv(e.select("vec_id", F.array((F.col("label") >= 5).cast("double")).alias("y")),
                       high_dir, "vec_id", "y")
    d = read_dataset(spark, feat, 64, [lab_dir, high_dir], target_names=["y_label", "y_high"])
    return d.select("record_id", "y_label", "y_high", F.size("features").alias("width"),
                    *[r6(F.col("features")[i]).alias(f"f{i}") for i in range(64)])


@register("s5_compact")
def q_s5(spark, sf_dir):
    from ..session import scratch_path
    from ..sources.numbered import read_numbered_csv
    from ..sources.store import compact
    path = _export_embeddings(spark, sf_dir)
    landed = compact(read_numbered_csv(spark, path, 64), scratch_path(spark, "emb-parquet"))
    return _flat(landed, "features", 64)


@register("e7_parse_numeric")
def q_e7(spark, sf_dir):
    """Values of the exported vectors, with an empty and a suffixed field planted by id; valid rows and bad fields."""
    from ..session import scratch_path
    from ..sources.numbered import validate_numeric
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<string>").alias("x"))
    bad = (F.when(F.col("vec_id") % 7 == 3, F.lit("")).when(F.col("vec_id") % 11 == 5, F.lit("1.5f"))
           .when(F.col("vec_id") % 13 == 6, F.lit("x")))
    fields = F.transform("x", lambda v, i: F.when((i == F.col("vec_id") % 64) & bad.isNotNull(), bad).otherwise(v))
    path = scratch_path(spark, "fields")
    e.select(F.concat_ws(",", fields).alias("value")).write.text(path, lineSep="\n")
    return validate_numeric(spark, path, 64, glob="*.txt")


# ---------------------------------------------------------------- fixed small net

def fixed_weights(n_in: int = 64, hidden: int = 4):
    """Small integer-valued net defined by a rule: W1 (hidden x n_in), b1, a sigmoid
    unit and a 3-class softmax head."""
    w1 = [[float((i * 7 + j * 3) % 5 - 2) for i in range(n_in)] for j in range(hidden)]
    b1 = [float(j - 1) for j in range(hidden)]
    w_bin = [[0.5, -0.5, 1.0, -1.0]]
    b_bin = [0.1]
    w_cls = [[0.5, 0.0, -0.5, 0.25], [0.0, 0.5, 0.25, -0.5], [-0.5, 0.25, 0.5, 0.0]]
    b_cls = [0.0, 0.1, -0.1]
    return w1, b1, w_bin, b_bin, w_cls, b_cls


def fixed_net():
    """The same weights as a NetSpec + flat parameter vector (for V1 / S7)."""
    import numpy as np

    from .net import Head, NetSpec
    w1, b1, w_bin, b_bin, w_cls, b_cls = fixed_weights()
    spec = NetSpec(n_in=64, hidden=4, heads=[Head("bin", 1, "y_bin"), Head("cls", 3, "y_cls")])
    theta = np.concatenate([np.asarray(w1).T.ravel(), np.asarray(b1), np.asarray(w_bin).T.ravel(),
                            np.asarray(b_bin), np.asarray(w_cls).T.ravel(), np.asarray(b_cls)])
    return spec, theta


def _emb_features(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features"))


@register("e8_dense_forward")
def q_e8(spark, sf_dir):
    w1, b1, w_bin, b_bin, w_cls, b_cls = fixed_weights()
    e = _emb_features(spark, sf_dir)
    out = e.select("vec_id", nn.dense_forward("features", w1, b1, w_bin, b_bin, "sigmoid")[0].alias("p_bin"),
                   nn.dense_forward("features", w1, b1, w_cls, b_cls, "softmax").alias("pc"))
    return out.select("vec_id", r6("p_bin").alias("p_bin"), *[r6(F.col("pc")[k]).alias(f"p_c{k}") for k in range(3)])


def _fixed_scored(df):
    return df.select("vec_id", r6("p_bin").alias("p_bin"), *[r6(F.col("p_cls")[k]).alias(f"p_c{k}") for k in range(3)])


@register("v1_predict")
def q_v1(spark, sf_dir):
    from .score import predict
    spec, theta = fixed_net()
    return _fixed_scored(predict(_emb_features(spark, sf_dir), spec, theta, keep=["vec_id"]))


def _planted(spark, sf_dir) -> DataFrame:
    """embeddings with labels of both heads of the fixed net, split by id."""
    e = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features"),
        (F.col("label") >= 5).cast("double").alias("y_bin"), (F.col("label") % 3).cast("double").alias("y_cls"))
    return sp.assign_split(e, "vec_id", 0.8, 0.1)


def _gradient(spark, sf_dir, spec, theta):
    from .train import summed_gradient
    g = summed_gradient(_planted(spark, sf_dir), spec, theta)
    return g.select("param", "i", F.round("gradient", 4).alias("gradient"))


@register("m3_gradient")
def q_m3_gradient(spark, sf_dir):
    """Summed gradient of the fixed net's binary head, by the training tasks' arithmetic."""
    from dataclasses import replace
    spec, theta = fixed_net()
    one = replace(spec, heads=spec.heads[:1])
    return _gradient(spark, sf_dir, one, theta[:one.n_params()])


@register("m5_gradient")
def q_m5_gradient(spark, sf_dir):
    """Summed gradient of the fixed net with both heads on one trunk."""
    return _gradient(spark, sf_dir, *fixed_net())


@register("v3_evaluate_fixed")
def q_v3_fixed(spark, sf_dir):
    """Metrics of the fixed net on train and valid, by the job that evaluates an epoch."""
    from .train import epoch_metrics, prepare
    spec, theta = fixed_net()
    data = prepare(_planted(spark, sf_dir), spec, id_col="vec_id")
    rows = [(m["split"], m["task"], m["auc"], m["n_classes"], m["loss"], m["rows"])
            for m in epoch_metrics(data, spec, theta)]
    df = spark.createDataFrame(rows, "split string, task string, auc double, n_classes long, loss double, rows long")
    return df.select("split", "task", r6("auc").alias("auc"), "n_classes", r6("loss").alias("loss"), "rows")


@register("v4_report_fixed")
def q_v4_fixed(spark, sf_dir):
    """Train and test report of the fixed net."""
    from .train import FitResult, final_report
    spec, theta = fixed_net()
    rep = final_report(_planted(spark, sf_dir), FitResult(spec=spec, theta=theta))
    return rep.select("split", "task", r6("auc_exact").alias("auc_exact"), r6("auc_binned").alias("auc_binned"),
                      F.col("n_classes").cast("long").alias("n_classes"), r6("loss").alias("loss"), "rows")


@register("s7_model_roundtrip")
def q_s7(spark, sf_dir):
    from ..session import scratch_path
    from ..sources.models import load_model, save_model
    from .score import predict
    spec, theta = fixed_net()
    path = scratch_path(spark, "model")
    save_model(spark, spec, theta, path)
    spec2, theta2 = load_model(spark, path)
    return _fixed_scored(predict(_emb_features(spark, sf_dir), spec2, theta2, keep=["vec_id"]))


# ---------------------------------------------------------------- training on the derived cohort

def cohort_dataset(spark, sf_dir) -> DataFrame:
    """(record_id, split, features, y_mortality, y_los, y_survival): 80/10/10 of the order id space."""
    from .cohort import cohort_features, cohort_labels
    labels = cohort_labels(spark, sf_dir)
    d = al.align_many(cohort_features(spark, sf_dir), labels)
    # the id space is the record table (every order is a record), read narrow
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("record_id"))
    return sp.assign_split(d, "record_id", 0.8, 0.1, id_space=ids)


def _runs(spark, sf_dir) -> str:
    """The shared folder of what is kept about one state of the record tables: the prepared cohort and training runs."""
    from ..session import checkpoint_root
    from .tables import fingerprint
    return f"{checkpoint_root(spark).rstrip('/')}/orrery-runs/{fingerprint(spark, sf_dir, 'orders', 'lineitem')}"


def cohort_prepared(spark, sf_dir) -> DataFrame:
    """The cohort with all three label sets, typed and by split; written once for one state of its tables."""
    from .train import open_prepared, prepare
    path, spec = f"{_runs(spark, sf_dir)}/cohort", _spec_multitask()
    there = open_prepared(spark, path, spec)
    return there if there is not None else prepare(cohort_dataset(spark, sf_dir), spec, path=path)


def _run(spark, sf_dir, key: str, spec, resume: bool = False):
    """Train ``spec`` on the cohort, with a checkpoint after every epoch as the reference does.

    With ``resume`` the run is the one that is kept under its name: finished
    if it was cut off, trained if there is none.  Queries that report on a run
    take it so, as the reference's report reloads the saved model.
    """
    from .train import fit
    path = f"{_runs(spark, sf_dir)}/{key}"
    return fit(None, spec, prepared=cohort_prepared(spark, sf_dir), checkpoint_path=path, resume=resume)


def _spec_mortality():
    from .net import Head, NetSpec
    from .cohort import WIDTH
    return NetSpec(n_in=WIDTH, hidden=500, heads=[Head("mortality", 1, "y_mortality")])


def _spec_los():
    from ..operators.encode import NB_LOS
    from .cohort import WIDTH
    from .net import Head, NetSpec
    return NetSpec(n_in=WIDTH, hidden=750, heads=[Head("los", NB_LOS, "y_los")])


def _spec_survival():
    from ..operators.encode import NB_SURVIVAL
    from .cohort import WIDTH
    from .net import Head, NetSpec
    return NetSpec(n_in=WIDTH, hidden=500, heads=[Head("survival", NB_SURVIVAL, "y_survival")])


def _spec_multitask():
    from ..operators.encode import NB_LOS, NB_SURVIVAL
    from .cohort import WIDTH
    from .net import Head, NetSpec
    return NetSpec(n_in=WIDTH, hidden=750, heads=[Head("mortality", 1, "y_mortality"),
                                                   Head("los", NB_LOS, "y_los"),
                                                   Head("survival", NB_SURVIVAL, "y_survival")])


_METRIC_SCHEMA = "epoch int, split string, task string, auc double, n_classes long, loss double, rows long"


def _metrics_df(spark, res):
    rows = [(m["epoch"], m["split"], m["task"], m["auc"], m["n_classes"], m["loss"], m["rows"])
            for m in res.metrics]
    return spark.createDataFrame(rows, _METRIC_SCHEMA)


@register("m3_fit_binary")
def q_m3(spark, sf_dir):
    return _metrics_df(spark, _run(spark, sf_dir, "mortality", _spec_mortality()))


@register("m4_fit_multiclass")
def q_m4(spark, sf_dir):
    return _metrics_df(spark, _run(spark, sf_dir, "los", _spec_los()))


@register("m4_fit_survival")
def q_m4_survival(spark, sf_dir):
    """M4, second configuration: survival buckets (5 classes, one unknown), 500-unit trunk."""
    return _metrics_df(spark, _run(spark, sf_dir, "survival", _spec_survival()))


@register("m5_fit_multitask")
def q_m5(spark, sf_dir):
    return _metrics_df(spark, _run(spark, sf_dir, "multitask", _spec_multitask()))


@register("v3_evaluate_per_epoch")
def q_v3(spark, sf_dir):
    """Per-epoch train/valid AUC of the multi-task run, with the task mean beside it."""
    m = _metrics_df(spark, _run(spark, sf_dir, "multitask", _spec_multitask(), resume=True)).withColumn(
        "task_no", F.when(F.col("task") == "mortality", 0).when(F.col("task") == "los", 1).otherwise(2))
    mean = au.auc_task_mean(m, ["epoch", "split"])
    return mean.select("epoch", "split", "auc_mean", "n_tasks",
                       *[F.col("per_task")[i]["auc"].alias(f"auc_{t}") for i, t in
                         enumerate(["mortality", "los", "survival"])])


@register("t1_history")
def q_t1(spark, sf_dir):
    """Iteration history of the multi-task run, as its tasks wrote it: rows of each epoch and lines that are missing."""
    from .train import HISTORY_EVERY
    lines = _run(spark, sf_dir, "multitask", _spec_multitask(), resume=True).history(spark)
    per = lines.groupBy("epoch", "shard").agg(
        F.sum("rows").alias("rows"), F.max("step").alias("steps"), F.count(F.lit(1)).alias("lines"),
        F.min((~F.isnan("loss") & (F.col("loss") > 0) & (F.col("records_per_second") > 0)).cast("int")).alias("sound"))
    due = F.ceil(F.col("steps") / HISTORY_EVERY)
    return per.groupBy("epoch").agg(F.count(F.lit(1)).alias("shards"), F.sum("rows").alias("rows"),
                                    F.sum(due - F.col("lines")).cast("long").alias("missing"), F.min("sound").alias("sound"))


@register("v4_final_report")
def q_v4(spark, sf_dir):
    """Reload the per-epoch model checkpoint (S7) and report train and test AUC."""
    from ..sources.models import load_state
    from .net import EPOCHS
    from .train import FitResult, final_report
    path = f"{_runs(spark, sf_dir)}/multitask"
    saved = load_state(spark, path)
    if saved is None or saved.progress["epoch"] < EPOCHS - 1:
        _run(spark, sf_dir, "multitask", _spec_multitask(), resume=True)
        saved = load_state(spark, path)
    return final_report(cohort_prepared(spark, sf_dir), FitResult(spec=saved.spec, theta=saved.theta))


@register("s6_write_metrics")
def q_s6(spark, sf_dir):
    """Metrics of five epochs and two runs through the sink; epoch 3 fails after its first write and is written again."""
    from ..session import scratch_path
    from ..sources.store import read_metrics, write_metrics
    path = scratch_path(spark, "metrics")
    # Rounded scores: equal ones stay equal whatever library computes the exponential.
    scored = epoch_scored(spark, sf_dir).withColumn("p", F.round("p", 9)).withColumn("loss", nn.bce("y", "p"))
    auc = au.auc_exact(scored, ["epoch", "split", "task"])
    loss = scored.groupBy("epoch", "split", "task").agg(F.avg("loss").alias("loss"), F.count(F.lit(1)).alias("rows"))
    m = auc.join(loss, ["epoch", "split", "task"]).select(
        "epoch", "split", "task", F.lit(0).alias("class"), "auc", "loss", "rows",
        (F.col("epoch") * 1.5).alias("seconds")).checkpoint()
    for run in ("first", "second"):
        rows = m.withColumn("run_id", F.lit(run))
        write_metrics(rows.where("epoch = 3").withColumn("auc", F.lit(-1.0)), path)
        write_metrics(rows.where("epoch <= 3"), path)
        write_metrics(rows.where("epoch > 3"), path)
    return read_metrics(spark, path).select("run_id", "epoch", "split", "task", "class", r6("auc").alias("auc"),
                                            r6("loss").alias("loss"), "rows", "seconds")


@register("m6_fit_builtin")
def q_m6(spark, sf_dir):
    from ..session import scratch_path
    from .train import fit_builtin
    # iterative optimizers re-read their input every iteration: use the checkpointed cohort
    data = cohort_prepared(spark, sf_dir)
    lr = fit_builtin(data, "y_mortality", 1, model_path=scratch_path(spark, "mllib-lr"))
    mlp = fit_builtin(data, "y_los", 8, hidden=750, model_path=scratch_path(spark, "mllib-mlp"))
    a = au.auc_exact(lr, ["split"]).withColumn("model", F.lit("logistic_mortality"))
    pc = au.auc_per_class(mlp.select("split", "y", "p"), ["split"])
    b = au.auc_macro(pc, ["split"]).select("split", F.col("auc_macro").alias("auc")).withColumn(
        "model", F.lit("perceptron_los"))
    return a.select("model", "split", "auc").unionByName(b.select("model", "split", "auc"))


@register("m7_fit_grid")
def q_m7(spark, sf_dir):
    """Grid over learning rate and trunk width, one job an epoch for all of it; pick by validation AUC."""
    from ..operators.summary import best_epoch
    from .cohort import WIDTH
    from .net import Head, NetSpec
    from .train import fit_grid
    grid = [(lr, hidden) for lr in (0.005, 0.001) for hidden in (100, 500)]
    specs = [NetSpec(n_in=WIDTH, hidden=hidden, heads=[Head("mortality", 1, "y_mortality")], lr=lr) for lr, hidden in grid]
    fits = fit_grid(None, specs, prepared=cohort_prepared(spark, sf_dir), eval_splits=("valid",))
    best = best_epoch(_grid_metrics(spark, fits), ["task"], epoch=["config", "epoch"])
    return best.select("task", F.col("best_config").alias("config"), F.col("best_epoch").alias("epoch"),
                       "valid_auc")


def _grid_metrics(spark, fits) -> DataFrame:
    rows = [(r.config, m["epoch"], m["split"], m["task"], m["auc"]) for r in fits for m in r.metrics]
    return spark.createDataFrame(rows, "config int, epoch int, split string, task string, auc double")


def _linear_label(spark, sf_dir) -> DataFrame:
    """embeddings with a label that is a fixed linear rule of the vector, split by id."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("features"))
    rule = nn.dense("features", class_map(64, 1), [0.0])[0]
    return sp.assign_split(e.withColumn("y", (rule > 0).cast("int")), "vec_id", 0.8, 0.1)


@register("m7_grid_planted")
def q_m7_planted(spark, sf_dir):
    """A grid of four on a label that a linear rule plants: every configuration is judged, the best one has learned it."""
    from ..operators.summary import best_epoch
    from .net import Head, NetSpec
    from .train import fit_grid
    specs = [NetSpec(n_in=64, hidden=hidden, heads=[Head("t", 1, "y")], lr=lr, epochs=12)
             for lr in (0.02, 0.002) for hidden in (8, 32)]
    m = _grid_metrics(spark, fit_grid(_linear_label(spark, sf_dir), specs, id_col="vec_id", shards=2))
    top = best_epoch(m, ["task"], epoch=["config", "epoch"])
    judged = m.groupBy("task").agg(F.count_distinct("config").alias("n_configs"), F.count_distinct("epoch").alias("n_epochs"),
                                   F.count(F.lit(1)).alias("n_metrics"),
                                   F.max(F.when(F.col("split") == "valid", F.col("auc"))).alias("most"))
    return judged.join(top, "task").select(
        "task", "n_configs", "n_epochs", "n_metrics", (F.col("valid_auc") == F.col("most")).cast("int").alias("is_best"),
        (F.col("valid_auc") >= 0.85).cast("int").alias("learned"))


@register("m6_builtin_planted")
def q_m6_planted(spark, sf_dir):
    """The library baselines on the planted label: rows of each split, and whether the model has learned it."""
    from .train import fit_builtin
    data = _linear_label(spark, sf_dir).withColumnRenamed("vec_id", "record_id").checkpoint()
    a = au.auc_exact(fit_builtin(data, "y", 1), ["split"])
    return a.select("split", (F.col("n_pos") + F.col("n_neg")).alias("rows"), "n_pos",
                    (F.col("auc") >= 0.85).cast("int").alias("learned"))


@register("m4_gradient")
def q_m4_gradient(spark, sf_dir):
    """Summed gradient of the fixed net's softmax head alone, by the training tasks' arithmetic."""
    from dataclasses import replace

    import numpy as np
    spec, theta = fixed_net()
    one = replace(spec, heads=spec.heads[1:])
    trunk = spec.n_in * spec.hidden + spec.hidden
    return _gradient(spark, sf_dir, one, np.concatenate([theta[:trunk], theta[trunk + spec.hidden + 1:]]))


@register("j2_align_landed")
def q_j2_landed(spark, sf_dir):
    """J2 over tables that landed in buckets by record id: joined bucket by bucket, without a shuffle."""
    from ..session import scratch_path
    from ..sources.store import land
    from .cohort import cohort_labels
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("record_id"), "o_totalprice")
    features = land(orders, scratch_path(spark, "landed-features"))
    labels = {t: land(d, scratch_path(spark, f"landed-{t}")) for t, d in cohort_labels(spark, sf_dir).items()}
    j = al.align_landed(features, labels)
    return j.select("record_id", r6("o_totalprice").alias("o_totalprice"), "y_mortality", "y_los", "y_survival")


@register("s4_sequence_dataset")
def q_s4_sequences(spark, sf_dir):
    """Sequence files of all events with two label folders, and the first record marked."""
    from ..operators.summary import first_records
    from ..session import scratch_path
    from ..sources.numbered import read_dataset, write_numbered_csv
    from .tables import hours
    events = table(spark, sf_dir, "events")
    paths = {k: scratch_path(spark, f"seq-{k}") for k in ("x", "many", "last")}
    write_numbered_csv(events.select("user_id", F.struct("ts", "event_id").alias("o"),
                                     F.array(F.col("value"), hours(events, "ts")).alias("x")),
                       paths["x"], "user_id", "x", header="value,hour", order_col="o")
    per = events.groupBy("user_id").agg((F.count(F.lit(1)) % 3).alias("many"), (F.max("event_id") % 2).alias("last"))
    for k in ("many", "last"):
        write_numbered_csv(per.select("user_id", F.array(F.col(k).cast("double")).alias("y")), paths[k], "user_id", "y")
    d = read_dataset(spark, paths["x"], 2, [paths["many"], paths["last"]], target_names=["y_many", "y_last"], sequence=True)
    first = first_records(d.select("record_id"), 1).withColumn("is_first", F.lit(1))
    d = d.join(F.broadcast(first), "record_id", "left")  # one row
    return d.select("record_id", "step", r6(F.col("x")[0]).alias("value"), r6(F.col("x")[1]).alias("hour"),
                    "y_many", "y_last", F.coalesce("is_first", F.lit(0)).alias("is_first"))


@register("program_run")
def q_program(spark, sf_dir):
    """The end-to-end program over numbered folders of all vectors: report rows, classes, and metrics that it wrote."""
    from ..session import scratch_path
    from ..sources.numbered import write_numbered_csv
    from ..sources.store import read_metrics
    from .programs import run_program
    base, out = scratch_path(spark, "program-in"), scratch_path(spark, "program-out")
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))
    write_numbered_csv(e, f"{base}/features", "vec_id", "x")
    for task, y in (("mortality", F.col("label") >= 5), ("los_bucket", F.col("label") % 8), ("survival_bucket", F.col("label") % 5)):
        write_numbered_csv(e.select("vec_id", F.array(y.cast("double")).alias("y")), f"{base}/{task}", "vec_id", "y")
    res = run_program(spark, base, out, hidden=16, epochs=3, width=64, n_train=0.8, n_valid=0.1, shards=2)
    wrote = read_metrics(spark, f"{out}/metrics").groupBy("task").agg(
        F.count_distinct("epoch").alias("epochs"), F.count(F.lit(1)).alias("n_metrics"))
    sound = F.col("auc_exact").isNull() | F.col("auc_exact").between(0, 1)
    return res.report.join(wrote, "task").select("split", "task", "rows", "n_classes", "epochs", "n_metrics",
                                                 sound.cast("int").alias("sound"))


# ---------------------------------------------------------------- streaming forms (S1+S5, A3)

@register("s5_land_stream")
def q_s5_stream(spark, sf_dir):
    """Numbered files landed incrementally into Parquet by a file-source stream."""
    from ..session import scratch_path
    from ..streaming.landing import land_numbered_csv
    src = _export_embeddings(spark, sf_dir)
    landed = land_numbered_csv(spark, src, 64, scratch_path(spark, "emb-stream"),
                               scratch_path(spark, "emb-stream-ckpt"))
    return _flat(landed, "features", 64)


@register("a3_roc_histogram_stream")
def q_a3_stream(spark, sf_dir):
    """Scored documents arrive as several Parquet files; the ROC histogram is streaming state."""
    from ..session import scratch_path
    from ..streaming.roc import accumulate_histograms
    src = scratch_path(spark, "scored-docs")
    doc_scored_long(spark, sf_dir).repartition(4, "doc_id").write.parquet(src)
    return accumulate_histograms(spark, src, "doc_id long, split string, task string, y int, p double",
                                 ["split", "task"], scratch_path(spark, "hist"), scratch_path(spark, "hist-ckpt"))
