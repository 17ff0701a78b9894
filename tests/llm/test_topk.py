"""The best scores equal those of a full search."""

import numpy as np

from orrery.llm import topk


def brute(ids, x, k=20, every=20):
    q = np.floor(64 * np.asarray(x, np.float64)).astype(object)
    out = set()
    for i, a in zip(ids, q, strict=True):
        if i % every == 0:
            best = sorted(((-int(sum(a * b)), j) for j, b in zip(ids, q, strict=True) if j != i))[:k]
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(best)}
    return out


def search(spark, ids, x, **kw):
    df = spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x, strict=True)],
                               "vec_id long, embedding array<float>")
    return {tuple(r) for r in topk.search(df, **kw).collect()}


def test_random_clustered_and_tied(spark):
    rnd = np.random.default_rng(2)
    ids = rnd.permutation(400)
    x = rnd.normal(size=(400, 24)) + 3 * rnd.normal(size=(5, 24))[rnd.integers(0, 5, 400)]
    x[:130] = x[0]  # a third of the rows are one vector
    x = x.astype(np.float32)
    assert search(spark, ids, x) == brute(ids, x)


def test_blocks_smaller_than_the_table(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 50)
    monkeypatch.setattr(topk, "QUERIES", 4)
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(300, 7)).astype(np.float32)
    assert search(spark, np.arange(300), x, every=10) == brute(np.arange(300), x, every=10)


def _copied(spark, monkeypatch, ids, x, **kw):
    """The result, and for both meetings how many copies of rows met how many blocks of queries."""
    seen = []
    real = topk._meet

    def meet(ask, rows, k):
        seen.append((rows.count(), ask.select("__block").distinct().count()))
        return real(ask, rows, k)

    monkeypatch.setattr(topk, "_meet", meet)
    return search(spark, ids, x, **kw), seen


def test_clustered_vectors_meet_few_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 120)
    monkeypatch.setattr(topk, "QUERIES", 10)
    rnd = np.random.default_rng(8)
    centres = 40 * rnd.normal(size=(12, 32))
    ids = rnd.permutation(3000)
    x = (centres[rnd.integers(0, 12, 3000)] + rnd.normal(size=(3000, 32))).astype(np.float32)
    got, copies = _copied(spark, monkeypatch, ids, x, every=10)
    assert got == brute(ids, x, every=10)
    (first, _), (then, blocks) = copies
    assert first < 2 * 3000 and then < 0.35 * 3000 * blocks, copies


def test_large_blocks_meet_in_parts(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 20)
    monkeypatch.setattr(topk, "BLOCKS", 3)
    rnd = np.random.default_rng(9)
    x = rnd.normal(size=(300, 9)).astype(np.float32)
    assert search(spark, np.arange(300), x) == brute(np.arange(300), x)


def test_vectors_beyond_a_long_take_no_part(spark):
    x = np.array([[1e20, 0.0], [1.0, 2.0], [3.0, -1.0], [0.0, 2e9]], np.float32)
    keep = [1, 2]
    assert search(spark, [0, 20, 40, 60], x) == brute([20, 40], x[keep])


def test_few_rows_and_wide_values(spark):
    x = np.array([[1e12, -3.0], [5.0, 1e12], [1e9, 1e9]], np.float32)
    assert search(spark, [0, 20, 7], x[:3] / 1e6) == brute([0, 20, 7], x[:3] / 1e6)
    got = topk.block_top(np.array([[1e10, 1.0]]), np.array([0]), np.array([[1e8, 3.0], [-1e8, 5.0]]), np.array([1, 2]), 5)
    assert [list(map(int, c)) for c in got] == [[0, 0], [1, 2], [10**18 + 3, -10**18 + 5]]


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [], 1),
            (6, [3.0, 1.0], 1), (6, [3.0, 1.0], 1), (7, [1.0, 1.0, 1.0], 1), (None, [9.0, 9.0], 1), (20, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = sorted(map(tuple, topk.search(df).collect()))
    a, b = 64 * 64 * 5, 64 * 64 * 5
    assert got == [(0, 1, 6, a), (0, 2, 6, a), (0, 3, 20, b), (20, 1, 0, b), (20, 2, 6, a), (20, 3, 6, a)]
    assert topk.search(df.where("false")).count() == 0
