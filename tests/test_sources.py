"""Numbered CSV files: id ranges and pruning, missing ids, strict parsing, CRLF, headers, ragged sequences."""

import os

import pytest
from pyspark.sql import functions as F

from orrery.sources import numbered as nb
from orrery.sources.store import compact


def _write(d, name, text):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w", newline="") as f:
        f.write(text)


def test_range_inclusive_and_missing_id(spark, tmp_dir):
    d = os.path.join(tmp_dir, "feat")
    for i in range(20):
        if i != 5:
            _write(d, f"{i}.csv", f"{i}.0,{i * 2}.5,1e-3\n")
    got = nb.read_numbered_csv(spark, d, 3, lo=3, hi=7).orderBy("record_id").collect()
    assert [r["record_id"] for r in got] == [3, 4, 6, 7]
    assert got[0]["features"] == [3.0, 6.5, 0.001]


def test_range_filter_prunes_files(spark, tmp_dir):
    d = os.path.join(tmp_dir, "feat2")
    for i in range(20):
        _write(d, f"{i}.csv", f"{i}.0\n")
    df = nb.read_numbered_csv(spark, d, 1, lo=3, hi=7)
    assert sorted(r["record_id"] for r in df.collect()) == [3, 4, 5, 6, 7]

    def walk(p):
        yield p
        it = p.children().iterator()
        while it.hasNext():
            yield from walk(it.next())

    scans = [n for n in walk(df._jdf.queryExecution().executedPlan()) if "Scan" in n.nodeName()]
    assert [n.metrics().get("numFiles").get().value() for n in scans] == [5]     # 5 of 20 files opened


def test_strict_parse_fails(spark, tmp_dir):
    bad = os.path.join(tmp_dir, "bad")
    _write(bad, "1.csv", "1.0,x,3.0\n")
    with pytest.raises(Exception):
        nb.read_numbered_csv(spark, bad, 3).collect()
    short = os.path.join(tmp_dir, "short")
    _write(short, "1.csv", "1.0,2.0\n")
    with pytest.raises(Exception):
        nb.validate_numeric(spark, short, 3).collect()


def test_sequences_crlf_header_ragged(spark, tmp_dir):
    d = os.path.join(tmp_dir, "seq")
    _write(d, "0.csv", "a,b\r\n1,2\r\n3,4\r\n5,6\r\n")
    _write(d, "1.csv", "a,b\r\n7,8\r\n9,10\r\n11,12\r\n13,14\r\n")
    got = nb.read_sequences(spark, d, 2).orderBy("record_id", "step").collect()
    assert [(r["record_id"], r["step"]) for r in got] == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2), (1, 3)]
    assert got[3]["x"] == [7.0, 8.0]


def test_read_dataset_and_squeeze(spark, tmp_dir):
    f, y1, y2 = (os.path.join(tmp_dir, n) for n in ("f", "y1", "y2"))
    for i in range(6):
        _write(f, f"{i}.csv", f"{i}.0,1.0\n")
        _write(y1, f"{i}.csv", f"{i % 2}\n")
        if i != 4:
            _write(y2, f"{i}.csv", f"{i % 3},1\n")
    d = nb.read_dataset(spark, f, 2, [y1, y2], target_widths=[1, 2], start=0, end=0)
    rows = d.orderBy("record_id").collect()
    assert [r["record_id"] for r in rows] == [0, 1, 2, 3, 5]
    assert rows[1]["y0"] == 1.0 and rows[1]["y1"] == [1.0, 1.0]
    assert nb.read_dataset(spark, f, 2, y1, start=2, end=4).count() == 2


def test_export_roundtrip_and_compact(spark, tmp_dir):
    df = spark.createDataFrame([(i, [i * 0.1, 1 / 3.0]) for i in range(30)], "id long, x array<double>")
    d = os.path.join(tmp_dir, "exp")
    assert nb.write_numbered_csv(df, d, "id", "x") == 30
    back = nb.read_numbered_csv(spark, d, 2)
    assert sorted((r[0], tuple(r[1])) for r in back.collect()) == sorted((i, (i * 0.1, 1 / 3.0)) for i in range(30))
    landed = compact(back, os.path.join(tmp_dir, "pq"), num_partitions=3)
    assert landed.count() == 30
    assert landed.where(F.col("record_id").between(5, 9)).count() == 5


def test_sequence_file_split_across_partitions_keeps_row_order(spark, tmp_dir):
    d = os.path.join(tmp_dir, "bigseq")
    n = 600
    _write(d, "7.csv", "a,b\n" + "".join(f"{i},{i * 0.5}\n" for i in range(n)))
    _write(d, "8.csv", "a,b\n1,2\n")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = nb.read_sequences(spark, d, 2)
        raw = spark.read.option("header", True).csv(d)
        assert raw.rdd.getNumPartitions() > 3                          # the file really is split
        got = df.where("record_id = 7").orderBy("step").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert [r["step"] for r in got] == list(range(n))
    assert [r["x"][0] for r in got] == [float(i) for i in range(n)]


def test_csv_dir_with_a_file_not_named_by_a_number(spark, tmp_dir):
    d = os.path.join(tmp_dir, "mixed")
    _write(d, "3.csv", "1.0,2.0\n")
    _write(d, "notes.csv", "5.0,6.0\n")
    got = sorted((r["record_id"] is None, tuple(r["features"])) for r in nb.read_csv_dir(spark, d, 2).collect())
    assert got == [(False, (1.0, 2.0)), (True, (5.0, 6.0))]


def test_read_dataset_sequence_mode(spark, tmp_dir):
    s, y = os.path.join(tmp_dir, "sequence"), os.path.join(tmp_dir, "mortality")
    for i in range(4):
        _write(s, f"{i}.csv", "a,b\n" + "".join(f"{i}.{k},{k}\n" for k in range(i + 1)))
        _write(y, f"{i}.csv", f"{i % 2}\n")
    d = nb.read_dataset(spark, s, 2, y, start=1, end=3, sequence=True)
    got = sorted((r["record_id"], r["step"], r["y0"]) for r in d.collect())
    assert got == [(1, 0, 1.0), (1, 1, 1.0), (2, 0, 0.0), (2, 1, 0.0), (2, 2, 0.0)]


def _small_splits(spark, size):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    return old


def test_sequences_are_numbered_without_moving_their_rows(spark, tmp_dir):
    d = os.path.join(tmp_dir, "seq")
    lengths = {3: 700, 4: 1, 5: 40, 6: 0, 7: 333}
    for i, n in lengths.items():
        _write(d, f"{i}.csv", "a,b\n" + "".join(f"{k},{i}\n" for k in range(n)))
    old = _small_splits(spark, 256)
    try:
        df = nb.read_sequences(spark, d, 2)
        plan = df._jdf.queryExecution().executedPlan().toString()
        got = sorted((r.record_id, r.step, r.x[0], r.x[1]) for r in df.collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == sorted((i, k, float(k), float(i)) for i, n in lengths.items() for k in range(n))
    # only the counts of splits are exchanged: no exchange reads the fields
    before_join = plan[:plan.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in before_join and "c1#" not in plan[plan.index("BroadcastExchange"):]


def test_data_set_is_one_scan_and_one_shuffle(spark, tmp_dir):
    f, y1, y2 = (os.path.join(tmp_dir, n) for n in ("f", "y1", "y2"))
    for i in range(9):
        for d, text in ((f, f"{i}.5,2"), (y1, f"{i % 2}"), (y2, f"{i % 3}, 1e1\r")):
            _write(d, f"{i}.csv", text + "\n\n")
    df = nb.read_dataset(spark, f, 2, [y1, y2], target_widths=[1, 2])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "Join" not in plan
    rows = {r.record_id: (r.features, r.y0, r.y1) for r in df.collect()}
    assert rows == {i: ([i + 0.5, 2.0], float(i % 2), [float(i % 3), 10.0]) for i in range(9)}


@pytest.mark.parametrize("role, name, text, message", [
    ("f", "notes.csv", "1,2\n", "no record number"), ("y", "x1.csv", "1\n", "no record number"),
    ("y", "1.csv", "1\n0\n", "several lines"), ("y", "1.csv", "1,2\n", "not a line of 1 numbers"),
    ("f", "1.csv", "1\n", "not a line of 2 numbers"), ("f", "1.csv", "1,2,\n", "not a line of 2 numbers"),
    ("f", "1.csv", "1,\n", "not a line of 2 numbers"), ("f", "1.csv", "1,nan\n", "not a line of 2 numbers"),
])
def test_data_set_refuses(spark, tmp_dir, role, name, text, message):
    paths = {r: os.path.join(tmp_dir, r) for r in "fy"}
    for i in (1, 2):
        _write(paths["f"], f"{i}.csv", "1,2\n")
        _write(paths["y"], f"{i}.csv", "1\n")
    _write(paths[role], name, text)
    with pytest.raises(Exception, match=message):
        nb.read_dataset(spark, paths["f"], 2, [paths["y"]]).collect()


def test_numbered_files_and_sequences_refuse_other_names(spark, tmp_dir):
    d = os.path.join(tmp_dir, "n")
    _write(d, "1.csv", "1,2\n")
    _write(d, "one.csv", "1,2\n")
    for df in (nb.read_numbered_csv(spark, d, 2), nb.read_numbered_csv(spark, d, 2, lo=1, hi=5),
               nb.read_sequences(spark, d, 2, header_rows=0)):
        with pytest.raises(Exception, match="no record number"):
            df.collect()


def test_export_takes_relative_paths(spark, tmp_dir, monkeypatch):
    df = spark.createDataFrame([(1, [1.0, 1e-300, -12345678.9]), (2, [float(2 ** 70), 0.1, 3.0])], "id long, x array<double>")
    base = os.path.relpath(os.path.join(tmp_dir, "rel"))
    nb.write_numbered_csv(df, base, "id", "x")
    got = {r.record_id: r.features for r in nb.read_numbered_csv(spark, os.path.join(tmp_dir, "rel"), 3).collect()}
    assert got == {r.id: r.x for r in df.collect()}


def test_landed_tables_are_aligned_without_a_shuffle(spark, tmp_dir):
    from orrery.operators.align import align_landed, align_many
    from orrery.sources.store import land, open_landed
    x = spark.range(500).selectExpr("id as record_id", "array(id * 0.5) as x")
    labels = {k: spark.range(0, 600, step).selectExpr("id as record_id", f"id % 3 as y_{k}") for k, step in (("a", 2), ("b", 3))}
    landed = land(x, f"{tmp_dir}/x", buckets=6)
    also = {k: land(d, f"{tmp_dir}/{k}", buckets=6) for k, d in labels.items()}
    df = align_landed(landed, also)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    want = sorted((r.record_id, r.x, r.y_a, r.y_b) for r in align_many(x, labels).collect())
    assert sorted((r.record_id, r.x, r.y_a, r.y_b) for r in df.collect()) == want and len(want) == 84
    # landing again replaces the table; another session opens it from its path
    land(labels["a"].where("record_id < 10"), f"{tmp_dir}/a", buckets=6)
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("landed_")]:
        spark.sql(f"DROP TABLE {name}")
    again = align_landed(open_landed(spark, f"{tmp_dir}/x"), {"a": open_landed(spark, f"{tmp_dir}/a")})
    assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.record_id for r in again.collect()) == [0, 2, 4, 6, 8]


def test_metrics_of_an_epoch_are_there_once(spark, tmp_dir):
    from orrery.sources.store import read_metrics, write_metrics
    path = f"{tmp_dir}/metrics"
    m = spark.createDataFrame([("7", e, s, "t", c, 0.5 + e / 100, 1.5) for e in (0, 1) for s in ("train", "valid") for c in (0, 1)],
                              "run_id string, epoch int, split string, task string, class int, auc double, seconds double")
    write_metrics(m, path)
    write_metrics(m.where("epoch = 1"), path)                                    # a retry
    write_metrics(m.where("epoch = 0").selectExpr("'8' as run_id", "epoch", "split", "task", "auc"), path)
    got = read_metrics(spark, path)
    assert {tuple(r) for r in got.groupBy("run_id", "epoch").count().collect()} == {("7", 0, 4), ("7", 1, 4), ("8", 0, 4)}
    row = got.where("run_id = '7' and epoch = 1 and class = 1 and split = 'valid'").first()
    assert (row.auc, row.seconds, row.loss, row.run_id) == (0.51, 1.5, None, "7")
    write_metrics(m.where("epoch = 1").withColumn("auc", F.lit(0.9)).limit(1), path)   # fewer rows replace more
    assert read_metrics(spark, path).where("run_id = '7' and epoch = 1").count() == 1
    with pytest.raises(ValueError, match="run_id"):
        write_metrics(m.drop("run_id"), path)
    with pytest.raises(ValueError, match="extra"):
        write_metrics(m.withColumn("extra", F.lit(1)), path)
