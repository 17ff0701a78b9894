from pyspark.sql import functions as F

from orrery.operators import align as al
from orrery.operators import split as sp


def test_slice_quirk(spark):
    df = spark.range(10).withColumnRenamed("id", "record_id")
    assert sp.slice_records(df, 0, 0).count() == 10          # 0 means unset
    assert sp.slice_records(df, 2, 5).count() == 3
    assert sp.slice_records(df, None, 4).count() == 4


def test_assign_split_integer_and_fraction(spark):
    df = spark.range(4000).withColumnRenamed("id", "record_id")
    c = {r["split"]: r["count"] for r in sp.assign_split(df).groupBy("split").count().collect()}
    assert c == {"train": 3200, "valid": 400, "test": 400}
    c = {r["split"]: r["count"] for r in sp.assign_split(df, n_train=0.8, n_valid=0.1).groupBy("split").count().collect()}
    assert c == {"train": 3200, "valid": 400, "test": 400}


def test_batch_numbers(spark):
    df = spark.range(100).withColumnRenamed("id", "record_id").withColumn("s", F.lit("train"))
    got = {r["record_id"]: r["batch_no"] for r in sp.batch_number(df, ["s"]).collect()}
    assert got[0] == 0 and got[31] == 0 and got[32] == 1 and got[99] == 3


def test_alignment_audit(spark):
    f = spark.createDataFrame([(1,), (2,), (2,), (3,)], "record_id int")
    l = spark.createDataFrame([(2,), (3,), (4,), (4,)], "record_id int")
    r = al.alignment_audit(f, {"y": l}).first()
    assert (r["matched"], r["missing_labels"], r["missing_features"], r["dup_feature_ids"], r["dup_label_ids"]) == \
        (2, 1, 1, 1, 1)


def test_best_epoch_ties_and_multi_candidates(spark):
    from orrery.operators.summary import best_epoch
    rows = [("t", 1, 0, "valid", 0.7), ("t", 1, 1, "valid", 0.8), ("t", 2, 0, "valid", 0.8),
            ("t", 1, 1, "test", 0.6), ("t", 2, 0, "test", 0.9)]
    m = spark.createDataFrame(rows, "task string, config int, epoch int, split string, auc double")
    r = best_epoch(m, ["task"], epoch=["config", "epoch"]).first()
    assert (r["best_config"], r["best_epoch"], r["valid_auc"], r["test_auc"]) == (1, 1, 0.8, 0.6)
    r = best_epoch(m.where("config = 1"), ["task"]).first()
    assert (r["best_epoch"], r["test_auc"]) == (1, 0.6)
