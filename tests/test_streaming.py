"""Streaming forms: incremental landing is exactly-once across restarts; streamed histograms equal batch ones."""

import os

import pytest

from orrery.operators import auc as au
from orrery.streaming.landing import land_numbered_csv
from orrery.streaming.roc import accumulate_histograms


def test_landing_resumes_without_duplicates(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    for i in range(5):
        with open(os.path.join(src, f"{i}.csv"), "w") as f:
            f.write(f"{i}.0,1.0\n")
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    assert land_numbered_csv(spark, src, 2, out, ck).count() == 5
    for i in range(5, 8):                                   # more records arrive
        with open(os.path.join(src, f"{i}.csv"), "w") as f:
            f.write(f"{i}.0,2.0\n")
    got = land_numbered_csv(spark, src, 2, out, ck)
    assert sorted(r["record_id"] for r in got.collect()) == list(range(8))


@pytest.mark.parametrize("name, text, message", [
    ("1.csv", "1.5f,2\n", "not a number"), ("1.csv", "1,\n", "not a number"), ("1.csv", ",2\n", "not a number"),
    ("1.csv", "1\n", "(?i)malformed|FAILED_READ_FILE"), ("1.csv", "nan,1\n", "not a number"), ("one.csv", "1,2\n", "no record number")])
def test_the_stream_is_strict(spark, tmp_dir, name, text, message):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    for n, t in (("0.csv", "1,2\n"), (name, text)):
        with open(os.path.join(src, n), "w") as f:
            f.write(t)
    with pytest.raises(Exception, match=message):
        land_numbered_csv(spark, src, 2, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"))


def test_streamed_histogram_equals_batch(spark, tmp_dir):
    import numpy as np
    rng = np.random.default_rng(0)
    rows = [(int(i), "s", int(rng.integers(0, 2)), float(rng.random())) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, split string, y int, p double")
    src = os.path.join(tmp_dir, "scored")
    df.repartition(5).write.parquet(src)
    streamed = accumulate_histograms(spark, src, "id long, split string, y int, p double", ["split"],
                                     os.path.join(tmp_dir, "h"), os.path.join(tmp_dir, "hck"))
    batch = au.roc_histogram(df, ["split"])
    norm = lambda d: sorted(tuple(r) for r in d.select("split", "bin", "pos", "neg").collect())
    assert norm(streamed) == norm(batch)


def test_batches_of_a_landing_grow_with_the_bytes_not_the_files(spark, tmp_dir):
    from pathlib import Path

    from orrery.streaming.landing import land_numbered_csv
    (src := Path(tmp_dir) / "in").mkdir()
    for i in range(1200):
        (src / f"{i}.csv").write_text(f"{i},1\n")

    def land(name, **bound):
        out = land_numbered_csv(spark, str(src), 2, f"{tmp_dir}/{name}", f"{tmp_dir}/{name}-ckpt", **bound)
        return sorted(r.record_id for r in out.collect()), len(list((Path(tmp_dir) / f"{name}-ckpt/commits").glob("[0-9]*")))

    assert land("whole") == (list(range(1200)), 1)
    rows, batches = land("cut", max_bytes_per_trigger=2500)  # some 7.5 kB
    assert rows == list(range(1200)) and 3 <= batches <= 5
