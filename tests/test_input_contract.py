"""Input that is not what it should be fails, instead of turning into something else."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.operators import auc as au
from orrery.operators import features as fe
from orrery.plans import train as tr
from orrery.plans.net import Head, NetSpec, init_params
from orrery.plans.score import predict
from orrery.sources import models
from orrery.sources import numbered as nb
from orrery.streaming.roc import accumulate_histograms


def write(folder, **files):
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name[1:]}.csv").write_text(text)
    return str(folder)


@pytest.mark.parametrize("bad", [",2.0", "1.0,", "1.5f,2.0", "1.5,2.0d", "x,1", "nan,1", "1e,2", "1 2,3", "--1,2"])
def test_every_field_must_be_a_number(spark, tmp_path, bad):
    path = write(tmp_path / "c", n1="1.0, -2e3\n", n2=f"{bad}\n")
    with pytest.raises(Exception, match="not a number|MALFORMED|Malformed"):
        nb.read_numbered_csv(spark, path, 2).select(F.col("features")[0]).collect()
    counts = nb.validate_numeric(spark, path, 2).first()
    assert counts.n_rows == 2 and counts.n_good_rows == 1 and counts.n_empty_fields + counts.n_bad_fields == 1
    assert counts.good_total == -1999.0


def test_good_fields_are_read(spark, tmp_path):
    path = write(tmp_path / "c", n1="+1, .5\t,2.,-3E-1\n")
    assert nb.read_numbered_csv(spark, path, 4).first().features == [1.0, 0.5, 2.0, -0.3]


def test_export_refuses_repeated_ids(spark, tmp_path):
    df = spark.createDataFrame([(1, [1.0]), (1, [2.0]), (2, [3.0])], "id long, x array<double>")
    with pytest.raises(ValueError, match="record id 1"):
        nb.write_numbered_csv(df, (tmp_path / "out").as_uri(), "id", "x")


SPEC = dict(n_in=2, hidden=3, heads=[Head("bin", 1, "y"), Head("cls", 3, "z")], epochs=1)


def rows(spark, *more):
    good = [(i, "train" if i % 4 else "valid", [float(i % 3), 1.0], float(i % 2), float(i % 3)) for i in range(24)]
    return spark.createDataFrame([*good, *more], "record_id long, split string, features array<double>, y double, z double")


@pytest.mark.parametrize("bad", [
    (99, "train", None, 1.0, 1.0), (99, "train", [None, 1.0], 1.0, 1.0), (99, "valid", [float("nan"), 1.0], 1.0, 1.0),
    (99, "train", [1.0], 1.0, 1.0), (99, "train", [1.0, 2.0, 3.0], 1.0, 1.0), (99, "train", [1.0, 2.0], 2.0, 1.0),
    (99, "train", [1.0, 2.0], 0.5, 1.0), (99, "train", [1.0, 2.0], 1.0, -1.0), (99, "valid", [1.0, 2.0], 1.0, 3.0),
    (99, "train", [1.0, 2.0], float("nan"), 1.0),
])
def test_training_refuses(spark, bad):
    with pytest.raises(Exception, match="feature|label"):
        tr.fit(rows(spark, bad), NetSpec(**SPEC), shards=1, standardize=False)


def test_a_null_label_is_left_out(spark):
    res = tr.fit(rows(spark, (99, "train", [1.0, 2.0], None, None)), NetSpec(**SPEC), shards=1)
    assert np.isfinite(res.theta).all()


def test_vectors_of_other_sizes_are_not_mixed(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0, 3.0])], "id long, features array<double>")
    spec = NetSpec(**SPEC)
    with pytest.raises(Exception, match="feature vector"):
        predict(df, spec, init_params(spec)).collect()


def test_shards_do_not_depend_on_the_rows(spark):
    sizes = []
    for n in (4096, 4097):
        df = spark.range(n).select(F.col("id").alias("record_id"), F.lit("train").alias("split"),
                                   F.array(F.col("id") % 2 * 1.0, F.lit(1.0)).alias("features"),
                                   (F.col("id") % 2).cast("double").alias("y"), (F.col("id") % 3).cast("double").alias("z"))
        sizes.append(tr.fit(df, NetSpec(**SPEC), eval_splits=()).shards)
    assert sizes == [tr.SHARDS, tr.SHARDS]


def test_the_driver_receives_one_state_of_many_shards(spark):
    df = spark.range(2000).select(F.col("id").alias("record_id"), F.lit("train").alias("split"),
                                  F.array(F.col("id") % 2 * 1.0, F.lit(1.0)).alias("features"),
                                  (F.col("id") % 2).cast("double").alias("y"), (F.col("id") % 3).cast("double").alias("z"))
    res = tr.fit(df, NetSpec(**SPEC), shards=300, eval_splits=())
    assert res.shards == 300 and res.history(spark).agg(F.sum("rows")).first()[0] == 2000


def test_validation_reads_its_own_files_only(spark):
    data = tr.prepare(rows(spark), NetSpec(**SPEC))
    plan = data.where("split = 'valid'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_wide_labels_stay(spark):
    df = spark.createDataFrame([([1, 2],), (None,)], "a array<int>")
    assert [r[0] for r in df.select(fe.squeeze_label("a", 2)).collect()] == [[1, 2], None]
    with pytest.raises(Exception, match="label width"):
        df.select(fe.squeeze_label("a", 1)).collect()


def test_scores_that_are_no_number_count_nowhere(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, float("nan")), (0, float("nan"))], "y int, p double").withColumn("k", F.lit(1))
    assert au.auc_exact(df, ["k"]).first().auc == 1.0
    assert au.auc_binned(au.roc_histogram(df, ["k"]), ["k"]).first().auc == 1.0


def test_streamed_histogram_equals_the_batch_form(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5, "a"), (0, 0.5, "a"), (2, 0.5, "a"), (None, 0.5, "a"), (1, None, "a")],
                               "y int, p double, k string")
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    df.write.parquet(src)
    got = accumulate_histograms(spark, src, "y int, p double, k string", ["k"], out, str(tmp_path / "ckpt"))
    want = sorted(map(tuple, au.roc_histogram(df, ["k"]).collect()))
    assert sorted(map(tuple, got.collect())) == want
    again = accumulate_histograms(spark, src, "y int, p double, k string", ["k"], out, str(tmp_path / "ckpt"))
    assert sorted(map(tuple, again.select("k", "bin", "pos", "neg").collect())) == want


def test_models_go_to_any_path_and_survive_a_cut_off_save(spark, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    spec = NetSpec(**SPEC)
    theta = init_params(spec)
    for path in (str(tmp_path / "plain"), (tmp_path / "uri").as_uri()):
        for k in range(4):
            models.save_model(spark, spec, theta + k, path)
        folder = tmp_path / path.rsplit("/", 1)[1]
        assert sorted(p.name for p in folder.iterdir()) == ["version=3", "version=4"]
        (folder / "version=5").mkdir()  # a save that never ended
        got_spec, got = models.load_model(spark, path)
        assert np.array_equal(got, theta + 3) and got_spec.heads == spec.heads
        models.save_model(spark, spec, theta + 9, path)
        assert np.array_equal(models.load_model(spark, path)[1], theta + 9)
