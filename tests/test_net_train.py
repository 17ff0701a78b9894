"""Network math, distributed training properties, scoring and model round trip."""

import numpy as np
import pytest

from orrery.plans import train as tr
from orrery.plans.net import Head, NetSpec, forward, init_params, loss_and_grad, train_pass
from orrery.plans.score import evaluate, predict


def _spec(**kw):
    return NetSpec(n_in=6, hidden=5, heads=[Head("b", 1, "yb"), Head("m", 4, "ym")], **kw)


def test_gradient_matches_finite_differences():
    spec = _spec()
    rng = np.random.default_rng(0)
    th = init_params(spec) + rng.normal(0, 0.1, spec.n_params())
    X = rng.normal(size=(7, 6))
    Y = {"b": rng.integers(0, 2, 7).astype(float), "m": rng.integers(0, 4, 7).astype(float)}
    Y["m"][2] = np.nan                                 # a missing label is skipped
    _, g = loss_and_grad(spec, th, X, Y)
    eps = 1e-6
    for i in rng.choice(spec.n_params(), 40, replace=False):
        e = np.zeros_like(th)
        e[i] = eps
        num = (loss_and_grad(spec, th + e, X, Y)[0] - loss_and_grad(spec, th - e, X, Y)[0]) / (2 * eps)
        assert g[i] == pytest.approx(num, rel=1e-4, abs=1e-7)


def _planted(spark, n=1200, d=8, seed=3):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, d))
    w = rng.normal(size=d)
    y = ((X @ w + 0.3 * rng.normal(size=n)) > 0).astype(int)
    split = np.where(np.arange(n) < 0.8 * n, "train", np.where(np.arange(n) < 0.9 * n, "valid", "test"))
    rows = [(i, str(split[i]), X[i].tolist(), int(y[i])) for i in range(n)]
    return X, y, spark.createDataFrame(rows, "record_id long, split string, features array<double>, y int")


def test_single_shard_equals_numpy_loop(spark):
    X, y, df = _planted(spark)
    spec = NetSpec(n_in=8, hidden=6, heads=[Head("t", 1, "y")], epochs=2)
    res = tr.fit(df, spec, shards=1, standardize=False, eval_splits=())
    ref = NetSpec(n_in=8, hidden=6, heads=[Head("t", 1, "y")], epochs=2)
    th, m, v, t = init_params(ref), 0.0, 0.0, 0
    m = np.zeros_like(th)
    v = np.zeros_like(th)
    ntr = int(0.8 * len(y))
    for _ in range(2):
        th, m, v, t, *_ = train_pass(ref, th, m, v, t, [(X[:ntr], {"t": y[:ntr].astype(float)})])
    assert np.abs(th - res.theta).max() < 1e-9


def test_learns_planted_target_and_is_repeatable(spark):
    _, _, df = _planted(spark)
    spec = lambda: NetSpec(n_in=8, hidden=16, heads=[Head("t", 1, "y")], epochs=4)
    r1 = tr.fit(df, spec(), shards=3)
    r2 = tr.fit(df.repartition(5), spec(), shards=3)
    assert np.abs(r1.theta - r2.theta).max() < 1e-9                    # depends on (K, seed) only
    valid = [m["auc"] for m in r1.metrics if m["split"] == "valid"]
    assert valid[-1] > valid[0] and valid[-1] > 0.8
    losses = [m["loss"] for m in r1.metrics if m["split"] == "train"]
    assert losses[-1] < losses[0]
    assert not any(m["split"] == "test" for m in r1.metrics)            # no test row in per-epoch evaluation


def test_multitask_with_one_live_head_equals_single_task(spark):
    """A second head whose labels are all missing adds no gradient: trunk and first head
    train exactly as in the single-task net, and only train rows reach training."""
    from pyspark.sql import functions as F

    from orrery.plans.net import unpack
    _, _, df = _planted(spark)
    df2 = df.withColumn("z", F.lit(None).cast("int"))
    single = NetSpec(n_in=8, hidden=6, heads=[Head("t", 1, "y")], epochs=2)
    multi = NetSpec(n_in=8, hidden=6, heads=[Head("t", 1, "y"), Head("u", 3, "z")], epochs=2)
    a = tr.fit(df, single, shards=2, eval_splits=())
    b = tr.fit(df2, multi, shards=2, eval_splits=())
    pa, pb = unpack(single, a.theta), unpack(multi, b.theta)
    for name in ("W1", "b1", "W_t", "b_t"):
        assert np.abs(pa[name] - pb[name]).max() < 1e-12
    n_train = df.where("split = 'train'").count()
    assert b.history(spark).where("epoch = 0").agg(F.sum("rows")).first()[0] == n_train


def test_fused_evaluation_equals_dataframe_evaluation(spark):
    rng = np.random.default_rng(5)
    spec = _spec()
    th = init_params(spec)
    rows = [(i, "train" if i % 3 else "valid", rng.normal(size=6).tolist(), int(rng.integers(0, 2)),
             None if i % 11 == 0 else int(rng.integers(0, 4))) for i in range(300)]
    df = spark.createDataFrame(rows, "record_id long, split string, features array<double>, yb int, ym int")
    fused = {(r["split"], r["task"]): r for r in tr.epoch_metrics(tr.prepare(df, spec), spec, th)}
    pred = predict(df, spec, th, keep=["split", "yb", "ym"])
    frame = {(r["split"], r["task"]): r for r in evaluate(pred, spec).collect()}
    assert fused.keys() == frame.keys()
    for k in fused:
        assert fused[k]["auc"] == pytest.approx(frame[k]["auc"], abs=1e-12)
        assert fused[k]["loss"] == pytest.approx(frame[k]["loss"], rel=1e-9)
        assert fused[k]["rows"] == frame[k]["rows"]


def test_predict_matches_forward_and_roundtrip(spark, tmp_dir):
    from orrery.sources.models import load_model, save_model
    spec = _spec()
    th = init_params(spec)
    X = np.random.default_rng(1).normal(size=(20, 6))
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(20)], "record_id long, features array<double>")
    got = sorted(predict(df, spec, th).collect(), key=lambda r: r["record_id"])
    exp = forward(spec, th, X)
    assert np.allclose([r["p_b"] for r in got], exp["b"])
    assert np.allclose([r["p_m"] for r in got], exp["m"])
    save_model(spark, spec, th, tmp_dir + "/model")
    spec2, th2 = load_model(spark, tmp_dir + "/model")
    assert spec2.to_json() == spec.to_json() and np.array_equal(th, th2)


def test_fixed_net_expression_equals_predict(spark):
    from orrery.plans.catalog import q_e8, q_v1
    sf = "/root/testdata/sf0.001"
    a = sorted(map(tuple, q_e8(spark, sf).collect()))
    b = sorted(map(tuple, q_v1(spark, sf).collect()))
    assert len(a) == len(b) and all(np.allclose(x[1:], y[1:], atol=2e-6) and x[0] == y[0] for x, y in zip(a, b))


def test_in_training_evaluation_equals_separate_evaluation(spark):
    _, _, df = _planted(spark, n=900)
    spec = NetSpec(n_in=8, hidden=6, heads=[Head("t", 1, "y")], epochs=2)
    seen = {}

    def grab(epoch, res, rows):
        seen[epoch] = res.theta.copy()

    res = tr.fit(df, spec, shards=2, on_epoch_end=grab)
    data = df.where("split in ('train', 'valid')").select("record_id", "split", "features",
                                                           df["y"].cast("double").alias("y"))
    assert np.array_equal(seen[1], res.theta)
    for epoch in (0, 1):
        pred = predict(data, spec, seen[epoch], keep=["split", "y"])
        sep = {(r["split"], r["task"]): r for r in evaluate(pred, spec).collect()}
        fused = {(m["split"], m["task"]): m for m in res.metrics if m["epoch"] == epoch}
        assert sep.keys() == fused.keys()
        for k in sep:
            assert fused[k]["auc"] == pytest.approx(sep[k]["auc"], abs=1e-12)
            assert fused[k]["loss"] == pytest.approx(sep[k]["loss"], rel=1e-9)
            assert fused[k]["rows"] == sep[k]["rows"]
    assert sorted({m["epoch"] for m in res.metrics}) == [0, 1]


def _small(epochs, **kw):
    return NetSpec(n_in=8, hidden=6, heads=[Head("t", 1, "y")], epochs=epochs, **kw)


def test_a_run_that_was_cut_off_ends_like_one_that_was_not(spark, tmp_dir):
    _, _, df = _planted(spark, n=600)
    whole = tr.fit(df, _small(5), shards=3, checkpoint_path=f"{tmp_dir}/a")

    class Lost(Exception):
        pass

    def lose(epoch, res, rows):
        if epoch == 2:
            raise Lost

    with pytest.raises(Lost):
        tr.fit(df, _small(5), shards=3, checkpoint_path=f"{tmp_dir}/b", on_epoch_end=lose)
    # a version that was cut off while it was written does not count
    (tmp := __import__("pathlib").Path(tmp_dir) / "b" / "version=9").mkdir()
    (tmp / "part-0.parquet").write_bytes(b"torn")
    told = []
    again = tr.fit(df, _small(5), shards=3, checkpoint_path=f"{tmp_dir}/b", resume=True,
                   on_epoch_end=lambda e, res, rows: told.append(e))
    assert np.abs(again.theta - whole.theta).max() < 1e-9 and told == [2, 3, 4]
    keys = ("epoch", "split", "task", "auc", "loss", "rows")
    assert [[m[k] for k in keys] for m in again.metrics] == [[m[k] for k in keys] for m in whole.metrics]
    # every epoch's history is there once
    lines = {r.epoch: r.n for r in again.history(spark).groupBy("epoch").agg({"rows": "sum"}).toDF("epoch", "n").collect()}
    assert lines == {e: 480 for e in range(5)}


def test_a_finished_run_goes_on_with_more_epochs_and_refuses_other_parameters(spark, tmp_dir):
    _, _, df = _planted(spark, n=400)
    short = tr.fit(df, _small(2), shards=2, checkpoint_path=f"{tmp_dir}/m")
    longer = tr.fit(df, _small(4), shards=2, checkpoint_path=f"{tmp_dir}/m", resume=True)
    whole = tr.fit(df, _small(4), shards=2)
    assert np.abs(longer.theta - whole.theta).max() < 1e-9 and len(longer.metrics) == len(whole.metrics) == 8
    done = tr.fit(df, _small(2), shards=2, checkpoint_path=f"{tmp_dir}/n", resume=True)   # nothing to resume: from the start
    assert np.abs(done.theta - short.theta).max() < 1e-9
    for spec, k in ((_small(4, lr=0.1), 2), (_small(4), 3)):
        with pytest.raises(ValueError, match="cannot be resumed"):
            tr.fit(df, spec, shards=k, checkpoint_path=f"{tmp_dir}/m", resume=True)


def test_grid_equals_training_each_alone(spark, tmp_dir):
    _, _, df = _planted(spark, n=500)
    specs = lambda: [NetSpec(n_in=8, hidden=h, heads=[Head("t", 1, "y")], epochs=e, lr=lr)
                     for h, lr, e in ((4, 0.005, 2), (9, 0.01, 3), (4, 0.05, 2))]
    together = tr.fit_grid(df, specs(), shards=2, checkpoint_path=f"{tmp_dir}/g")
    for i, spec in enumerate(specs()):
        alone = tr.fit(df, spec, shards=2)
        assert np.abs(alone.theta - together[i].theta).max() < 1e-9
        assert [(m["epoch"], m["split"], m["auc"]) for m in alone.metrics] == \
            [(m["epoch"], m["split"], m["auc"]) for m in together[i].metrics]
        assert together[i].history(spark).groupBy("epoch").count().count() == spec.epochs
    again = tr.fit_grid(df, specs(), shards=2, checkpoint_path=f"{tmp_dir}/g", resume=True)
    assert all(np.array_equal(a.theta, b.theta) for a, b in zip(again, together))


def test_history_has_every_tenth_step_of_every_shard(spark):
    _, _, df = _planted(spark, n=1500)
    res = tr.fit(df, _small(2), shards=2)
    lines = {}
    for r in res.history(spark).collect():
        lines.setdefault((r.epoch, r.shard), []).append((r.step, r.rows))
        assert np.isfinite(r.loss) and r.records_per_second > 0
    assert sorted(lines) == [(e, s) for e in (0, 1) for s in (0, 1)]
    for told in lines.values():
        rows = sum(n for _, n in told)
        steps = -(-rows // 32)
        assert sorted(s for s, _ in told) == sorted({*range(10, steps + 1, 10), steps})
    assert sum(n for (e, _), told in lines.items() if e == 1 for _, n in told) == 1200


def test_early_stopping_restores_the_best_epoch(spark, tmp_dir):
    from pyspark.sql import functions as F
    # Labels of the validation rows are the other way round: what training learns makes validation worse.
    _, _, df = _planted(spark, n=600)
    df = df.withColumn("y", F.when(F.col("split") == "valid", 1 - F.col("y")).when(F.col("split") == "test", F.lit(None))
                       .otherwise(F.col("y")))
    seen = []
    res = tr.fit(df, _small(12, lr=0.02), shards=2, patience=2, checkpoint_path=f"{tmp_dir}/m",
                 on_epoch_end=lambda e, r, rows: seen.append((e, r.theta.copy())))
    aucs = [m["auc"] for m in res.metrics if m["split"] == "valid"]
    assert res.best_epoch == int(np.argmax(aucs)) and res.stopped_after == res.best_epoch + 2 < 11
    short = tr.fit(df, _small(res.best_epoch + 1, lr=0.02), shards=2, eval_splits=())
    assert np.abs(short.theta - res.theta).max() < 1e-9
    # the best version outlives the ones after it, and a resumed run stops at the same epoch
    again = tr.fit(df, _small(12, lr=0.02), shards=2, patience=2, checkpoint_path=f"{tmp_dir}/m", resume=True)
    assert again.best_epoch == res.best_epoch and np.abs(again.theta - res.theta).max() < 1e-9
    rising = tr.fit(_planted(spark, n=600)[2], _small(3), shards=2, patience=3)
    assert rising.stopped_after is None


def test_report_equals_separate_evaluations(spark):
    rng = np.random.default_rng(7)
    spec = _spec()
    th = init_params(spec)
    rows = [(i, "train" if i % 3 else "test", np.round(rng.normal(size=6)).tolist(), None if i % 13 == 0 else int(rng.integers(0, 2)),
             None if i % 11 == 0 else int(rng.integers(0, 3))) for i in range(300)]
    df = spark.createDataFrame(rows, "record_id long, split string, features array<double>, yb int, ym int")
    pred = predict(df, spec, th, keep=["split", "yb", "ym"])
    got = {(r["split"], r["task"]): r for r in tr.final_report(df, tr.FitResult(spec, th)).collect()}
    for method in ("exact", "binned"):
        for r in evaluate(pred, spec, method=method).collect():
            g = got[r["split"], r["task"]]
            assert g["auc_" + method] == pytest.approx(r["auc"], abs=1e-12)
            assert (g["n_classes"], g["rows"]) == (r["n_classes"], r["rows"]) and g["loss"] == pytest.approx(r["loss"], rel=1e-9)
    assert len(got) == 4


def test_builtin_baseline_learns_and_round_trips(spark, tmp_dir):
    from orrery.operators.auc import auc_exact
    _, _, df = _planted(spark, n=800)
    scored = tr.fit_builtin(df, "y", 1, model_path=tmp_dir + "/lr")
    aucs = {r["split"]: r["auc"] for r in auc_exact(scored, ["split"]).collect()}
    assert aucs["valid"] > 0.9 and aucs["test"] > 0.9


def test_builtin_perceptron_works_on_equal_partitions(spark, monkeypatch, tmp_dir):
    from pyspark.sql import functions as F
    _, _, df = _planted(spark, n=800)
    for part in ("record_id < 700", "record_id >= 700"):  # two very unequal files
        df.where(part).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
    df = spark.read.parquet(f"{tmp_dir}/in")

    def scored():
        s = tr.fit_builtin(df, "y", 2, hidden=4)
        at = s.select("record_id", "split", "y", "p", F.spark_partition_id().alias("at")).collect()
        sizes = {}
        for r in at:
            sizes[r["at"]] = sizes.get(r["at"], 0) + 1
        return s.rdd.getNumPartitions(), sorted(sizes.values()), {r["record_id"]: (r["split"], r["y"], r["p"]) for r in at}

    n_scan, small, want = scored()
    assert (n_scan, small) == (2, [100, 700])  # small inputs stay as they are
    monkeypatch.setattr(tr, "EVEN_ROWS", 0, raising=False)
    n, sizes, got = scored()
    assert n == spark.sparkContext.defaultParallelism and sum(sizes) == 800 and max(sizes) - min(sizes) <= 2
    assert got.keys() == want.keys() and all(got[k][:2] == want[k][:2] for k in want)
    same = [np.argmax(got[k][2]) == np.argmax(want[k][2]) for k in want]
    assert np.mean(same) > 0.95  # not to the bit: blocks are cut elsewhere, so the optimizer takes another path


def test_a_pass_needs_no_new_arrays_a_step(monkeypatch):
    from orrery.plans import net
    spec = _small(1)
    n, calls = 320, []
    X, Y = np.random.default_rng(0).normal(size=(n, spec.n_in)), {h.task: np.ones(n) for h in spec.heads}
    spec.mean, spec.scale = [0.5] * spec.n_in, [2.0] * spec.n_in
    th = init_params(spec)
    want, m, v = th.copy(), np.zeros_like(th), np.zeros_like(th)
    for i in range(0, n, spec.batch):
        _, g = loss_and_grad(spec, want, X[i:i + spec.batch], {k: y[i:i + spec.batch] for k, y in Y.items()})
        net.adam_step(spec, want, m, v, i // spec.batch + 1, g)
    whole = net._standardize
    monkeypatch.setattr(net, "_standardize", lambda s, x: calls.append(len(x)) or whole(s, x))
    got = train_pass(spec, th, np.zeros_like(th), np.zeros_like(th), 0, [(X, Y)])
    assert (got[0] == want).all() and calls == [n]  # the same weights to the bit; a chunk is standardized once


def test_networks_side_by_side_end_as_alone():
    from orrery.plans.net import train_passes
    rng = np.random.default_rng(2)
    n, heads = 150, [Head("b", 1, "yb"), Head("m", 4, "ym")]
    X = rng.normal(size=(n, 6))
    Y = {"b": rng.integers(0, 2, n).astype(float), "m": rng.integers(0, 4, n).astype(float)}
    Y["m"][rng.random(n) < 0.2] = np.nan
    Y["b"][32:64] = np.nan                             # a batch without a label of the head
    specs = [NetSpec(6, h, heads, lr=lr, seed=s) for h, lr, s in ((5, 0.005, 1), (9, 0.05, 2), (5, 0.001, 3))]
    state = lambda: [(init_params(s), np.full(s.n_params(), 0.01), np.full(s.n_params(), 0.02)) for s in specs]
    cuts = [(X[a:b], {k: y[a:b] for k, y in Y.items()}) for a, b in ((0, 70), (70, 90), (90, n))]
    told = []
    states, t, rows, steps, sums = train_passes(specs, state(), 7, cuts, on_step=lambda *a: told.append(a), every=2)
    assert (t, rows, steps) == (12, n, 5) and [a[0] for a in told] == [2, 4, 5] and told[-1][3]
    for i, (spec, own) in enumerate(zip(specs, state())):
        losses = []
        one = train_pass(spec, *own, 7, [(X, Y)], on_step=lambda step, rows, loss, last: losses.append(loss))
        assert all(np.abs(a - b).max() < 1e-12 for a, b in zip(states[i], one[:3]))
        assert sums[i] == pytest.approx(one[6]) and [a[2][i] for a in told] == pytest.approx([losses[k] for k in (1, 3, 4)])


def test_teams_share_the_work():
    def run(hidden, t=0, batch=32):
        spec = NetSpec(n_in=8, hidden=hidden, heads=[Head("t", 1, "y")], batch=batch)
        return tr._Run(spec, tr._State(None, None, None, t), None)

    grid = [(i, run(h)) for i, h in enumerate((100, 500, 100, 500))]
    assert tr._teams(grid, 0) == tr._teams(grid, 1) == [[0, 1, 2, 3]]
    assert sorted(tr._teams(grid, 2)) == [[0, 1], [2, 3]]
    assert tr._teams(grid, 9) == [[1], [3], [0], [2]]  # those with most work first
    assert sorted(tr._teams([(0, run(4)), (1, run(4, t=5)), (2, run(4, batch=16)), (3, run(4))], 1)) == [[0, 3], [1], [2]]


def test_a_grid_reads_a_shard_once_an_epoch_and_scores_what_is_asked_for(spark, tmp_dir, monkeypatch):
    _, _, df = _planted(spark, n=700)
    grid = lambda: [_small(2, lr=lr) for lr in (0.005, 0.01, 0.02)]
    seen, whole = [], tr._epoch_job
    monkeypatch.setattr(tr, "_epoch_job", lambda *a, **k: seen.append(whole(*a, **k)) or seen[-1])
    k = spark.sparkContext.defaultParallelism
    res = tr.fit_grid(df, grid(), shards=k, eval_splits=("valid",), checkpoint_path=f"{tmp_dir}/g")
    lines = tr.read_history(spark, res[0].log_path).where("epoch = 0")
    assert lines.groupBy("config").agg({"rows": "sum"}).select("sum(rows)").collect() == [(560,)] * 3
    assert len(lines.inputFiles()) == 2 * k            # a file a task, of both epochs: tasks of all configurations
    for sums in seen:                                  # train rows are not scored for metrics that nobody reads
        assert sorted(sums) == [0, 1, 2] and all(x.losses[0].sum() == 0 for x in sums.values())
    full = tr.fit_grid(df, grid(), shards=k)
    for a, b in zip(res, full):
        assert np.abs(a.theta - b.theta).max() < 1e-9
        valid = [[m for m in r.metrics if m["split"] == "valid"] for r in (a, b)]
        assert [m["auc"] for m in valid[0]] == [m["auc"] for m in valid[1]] and len(valid[0]) == 2
        assert not [m for m in a.metrics if m["split"] == "train"]


def test_packs_hold_the_rows_of_a_shard_in_order(spark, monkeypatch):
    from pyspark.sql import functions as F
    _, _, df = _planted(spark, n=900)
    spec = _spec()
    spec.n_in, spec.heads = 8, [Head("t", 1, "y"), Head("u", 4, "z")]
    df = df.withColumn("z", F.when(F.col("record_id") % 7 > 0, F.col("record_id") % 4))
    data = tr.prepare(df, spec)
    was = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    with tr._arrow_bytes(spark, "1m"):
        packs = tr.shard(data.where("split = 'train'"), 2, spec).withColumn("at", F.spark_partition_id()).collect()
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == was
    want = data.where("split = 'train'").withColumn("at", F.expr("pmod(xxhash64(record_id), 2)")).orderBy("record_id").collect()
    assert {p["split"] for p in packs} == {"train"} and max(p["rows"] for p in packs) <= tr.PACK_ROWS
    for k in (0, 1):
        X = np.concatenate([np.frombuffer(p["features"]).reshape(p["rows"], 8) for p in packs if p["at"] == k])
        Y = np.concatenate([np.frombuffer(p["labels"]).reshape(p["rows"], 2) for p in packs if p["at"] == k])
        own = [r for r in want if r["at"] == k]
        assert np.array_equal(X, [r["features"] for r in own])
        assert np.array_equal(Y, [[r["y"], np.nan if r["z"] is None else r["z"]] for r in own], equal_nan=True)


def test_standardizer_is_that_of_the_rows(spark):
    rng = np.random.default_rng(4)
    X = np.concatenate([rng.normal(1e6, 1e-2, (700, 1)), np.full((700, 1), 0.3), rng.normal(size=(700, 4))], axis=1)
    df = spark.createDataFrame([(i, "train", x.tolist(), i % 2) for i, x in enumerate(X)],
                               "record_id long, split string, features array<double>, y int")
    spec = NetSpec(n_in=6, hidden=4, heads=[Head("t", 1, "y")])
    data = tr.prepare(df, spec)
    packs = tr.shard(data, 3, spec)
    mean, scale = tr.fit_standardizer(packs, 6)
    assert np.allclose(mean, X.mean(axis=0), rtol=1e-12) and np.allclose(scale, [*X.std(axis=0)[:1], 1.0, *X.std(axis=0)[2:]], rtol=1e-9)
    assert tr.fit_standardizer(packs, 6) == (mean, scale)  # to the bit: the tasks' sums are added up in their order
    assert tr.fit_standardizer(tr.shard(data.where("split = 'none'"), 3, spec), 6) == ([0.0] * 6, [1.0] * 6)
