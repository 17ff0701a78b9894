"""Held-out accuracy, and tables without what the fit needs."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from orrery.llm import quality
from orrery.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = QUERIES["op3_quality"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    held = rows.where("held_out").collect()
    assert len(held) > 500
    right = np.mean([r.predicted == r.quality for r in held])
    assert right >= 0.98, right
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in held)
    bad = [r for r in held if r.quality == 0]
    assert np.mean([r.predicted == 0 for r in bad]) >= 0.95


def test_fit_orders_pairs_and_cuts_at_the_share_of_bad_rows():
    rnd = np.random.default_rng(1)
    good, bad = rnd.normal(0, 1, (400, 3)) + [2, 0, 0], rnd.normal(0, 1, (100, 3))
    m = quality._solve(good, bad, 400, 100)
    strength = np.concatenate([good, bad]) @ np.array(m.weights)
    assert m.weights[0] > 3 * abs(m.weights[1])
    assert np.isclose((strength < m.cut).mean(), 0.2, atol=0.003)


def test_the_cut_covers_rows_that_the_fit_does_not_see(spark, monkeypatch):
    monkeypatch.setattr(quality, "FIT_ROWS", 40)
    rnd = np.random.default_rng(2)
    ids = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, [float(x) for x in rnd.normal([2 * (i % 4 > 0), 0], 1)]) for i in ids]
    rows += [(ids[0], rows[0][1])] * 3
    features = spark.createDataFrame(rows, f"doc_id long, {quality.FEATURES} array<double>")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in ids], "doc_id long, quality int")
    model = quality.fit(features, labels)
    assert features.where(model.score() < quality.CUT).count() == sum(i % 4 == 0 for i, _ in rows)


def test_features_are_finite_for_any_text():
    texts = pa.array(["", " ", "\n\n", "a", "!!!", "#" * 1000, "漢字", "A\nA\nA"], pa.large_string())
    x = quality._matrix(quality.TextStats(texts))
    assert np.isfinite(x).all() and (x >= 0).all()


@pytest.mark.parametrize("labels", [[], [(1, 1), (5, 1)], [(1, 0), (1, 1), (None, 0), (5, None)]])
def test_without_both_labels_all_score_half(spark, awkward, empty, labels):
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    rows = quality.with_features(awkward)
    model = quality.fit(rows, known)
    assert {r[0] for r in rows.select(model.score()).collect()} == {0.5}
    assert quality.with_features(empty).select(model.score()).count() == 0


def test_awkward_rows_are_scored(spark, awkward):
    known = spark.createDataFrame([(1, 1), (6, 0), (8, 0), (8, 0)], "doc_id long, quality int")
    rows = quality.with_features(awkward)
    model = quality.fit(rows, known)
    got = rows.select("doc_id", quality.held_out().alias("h"), model.score().alias("s")).collect()
    assert len(got) == awkward.count() and all(0 <= r.s <= 1 for r in got)
    assert [r.h for r in got if r.doc_id is None] == [False]
