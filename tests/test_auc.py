"""AUC properties and brute-force checks (exact and binned)."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orrery.operators import auc as au


def brute_auc(y, s):
    pos = [a for a, t in zip(s, y) if t == 1]
    neg = [a for a, t in zip(s, y) if t == 0]
    if not pos or not neg:
        return None
    tot = sum((1.0 if p > q else 0.5 if p == q else 0.0) for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def brute_binned(y, s, T=100):
    """Trapezoid over thresholds k/T, positive when s >= k/T, plus (0,0)."""
    y = np.asarray(y)
    s = np.asarray(s)
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    if n1 == 0 or n0 == 0:
        return None
    pts = [(0.0, 0.0)]
    for k in range(T, -1, -1):
        pred = s >= k / T - 5e-12
        pts.append((((pred) & (y == 0)).sum() / n0, ((pred) & (y == 1)).sum() / n1))
    return sum((x1 - x0) * (y1 + y0) / 2 for (x0, y0), (x1, y1) in zip(pts, pts[1:]))


def _df(spark, y, s, g=None):
    g = g if g is not None else [0] * len(y)
    return spark.createDataFrame(pd.DataFrame({"g": g, "y": y, "p": s}))


def _one(df, method="exact"):
    r = au.auc(df, ["g"], method=method).collect()
    return {row["g"]: row["auc"] for row in r}


@pytest.mark.parametrize("method", ["exact", "binned"])
def test_edge_cases(spark, method):
    assert _one(_df(spark, [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9]), method)[0] == pytest.approx(1.0)
    assert _one(_df(spark, [1, 1, 0, 0], [0.1, 0.2, 0.8, 0.9]), method)[0] == pytest.approx(0.0)
    assert _one(_df(spark, [0, 1, 0, 1], [0.5] * 4), method)[0] == pytest.approx(0.5)
    assert _one(_df(spark, [1, 1, 1], [0.1, 0.5, 0.9]), method)[0] is None


def test_exact_matches_brute_force_with_ties(spark):
    rng = np.random.default_rng(0)
    n = 600
    g = rng.integers(0, 3, n)
    y = rng.integers(0, 2, n)
    s = np.round(rng.random(n) * 0.5 + y * 0.2, 2)        # many ties
    got = _one(_df(spark, g=g.tolist(), y=y.tolist(), s=s.tolist()))
    for k in range(3):
        sel = g == k
        assert got[k] == pytest.approx(brute_auc(y[sel], s[sel]), abs=1e-12)


def test_binned_matches_threshold_definition(spark):
    rng = np.random.default_rng(1)
    n = 2000
    y = rng.integers(0, 2, n)
    s = np.concatenate([np.arange(101) / 100.0, rng.random(n - 101)])  # every exact threshold
    got = _one(_df(spark, y.tolist(), s.tolist()), "binned")[0]
    assert got == pytest.approx(brute_binned(y, s), abs=1e-9)


def test_invariances(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 500).tolist()
    s = rng.random(500)
    a = _one(_df(spark, y, s.tolist()))[0]
    assert _one(_df(spark, y, (1 - s).tolist()))[0] == pytest.approx(1 - a)
    assert _one(_df(spark, y, (s ** 3).tolist()))[0] == pytest.approx(a)         # strictly increasing map
    df = _df(spark, y, s.tolist())
    assert _one(df.repartition(7))[0] == pytest.approx(a)                         # partition count
    assert _one(df.orderBy(F.rand(5)))[0] == pytest.approx(a)                     # row order


def test_merged_histograms_equal_histogram_of_union(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400).tolist()
    s = rng.random(400).tolist()
    df = _df(spark, y, s)
    a, b = df.limit(150), df.subtract(df.limit(150))
    merged = au.merge_histograms(au.roc_histogram(a, ["g"]), au.roc_histogram(b, ["g"]), keys=["g"])
    whole = au.roc_histogram(df, ["g"])
    key = lambda r: r["bin"]
    assert sorted(map(tuple, merged.select("bin", "pos", "neg").collect()), key=lambda t: t[0]) == \
        sorted(map(tuple, whole.select("bin", "pos", "neg").collect()), key=lambda t: t[0])


def test_per_class_and_macro(spark):
    rows = [(0, [0.8, 0.1, 0.1]), (1, [0.2, 0.7, 0.1]), (2, [0.1, 0.1, 0.8]), (0, [0.6, 0.3, 0.1])]
    df = spark.createDataFrame(rows, "y int, p array<double>").withColumn("g", F.lit(0))
    pc = au.auc_per_class(df, ["g"]).collect()
    assert {r["class"]: r["auc"] for r in pc} == {0: 1.0, 1: 1.0, 2: 1.0}
    m = au.auc_macro(au.auc_per_class(df, ["g"]), ["g"]).first()
    assert m["auc_macro"] == 1.0 and m["n_classes"] == 3


def test_binned_converges_to_exact(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 3000)
    s = 1 / (1 + np.exp(-(rng.normal(size=3000) + y)))
    df = _df(spark, y.tolist(), s.tolist())
    exact = _one(df)[0]
    coarse = au.auc_binned(au.roc_histogram(df, ["g"], steps=10), ["g"], steps=10).first()["auc"]
    fine = au.auc_binned(au.roc_histogram(df, ["g"], steps=10000), ["g"], steps=10000).first()["auc"]
    assert abs(fine - exact) < abs(coarse - exact) and abs(fine - exact) < 1e-3
    assert not math.isnan(exact)


def test_exact_auc_with_a_hot_group_over_many_partitions(spark):
    rng = np.random.default_rng(9)
    n = 3000
    g = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 6, n))
    y = rng.integers(0, 2, n)
    s = np.round(rng.random(n) + 0.3 * y, 3)
    df = _df(spark, g=g.tolist(), y=y.tolist(), s=s.tolist())
    got = {r["g"]: r["auc"] for r in au.auc_exact(df, ["g"], num_partitions=13).collect()}
    for k in range(6):
        sel = g == k
        assert got[k] == pytest.approx(brute_auc(y[sel], s[sel]), abs=1e-12)


def test_rows_without_label_or_score_are_skipped(spark):
    rows = [(0, 1, 0.9), (0, 0, 0.1), (0, None, 0.5), (0, 1, None), (0, 0, 0.2)]
    df = spark.createDataFrame(rows, "g int, y int, p double")
    assert _one(df)[0] == 1.0
    assert _one(df, "binned")[0] == 1.0
