"""Components equal those of all compared pairs."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from orrery.llm import jaccard
from orrery.llm.common import components


def words(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(texts, k, num, den):
    sets = {i: words(t, k) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def same(spark, texts, k=4, num=85, den=100):
    df = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    rows = jaccard.join(df, k=k, num=num, den=den).collect()
    assert len(rows) == len(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(texts, k, num, den)


def edited(rnd, base, n):
    w = list(base)
    for _ in range(n):
        w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
    return w


def test_small_sets_near_the_limit(spark):
    rnd = random.Random(3)
    texts = {}
    for g in range(60):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(rnd.randrange(1, 40))]
        for _ in range(4):
            cut = rnd.randrange(0, 3)
            texts[len(texts)] = " ".join(base[cut:] + [f"e{rnd.randrange(10**6)}" for _ in range(rnd.randrange(3))])
    same(spark, texts)


def test_near_copies_and_shared_passages(spark):
    rnd = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    hot = [f"h{rnd.randrange(500)}" for _ in range(300)]
    texts = {}
    for i in range(120):
        if i % 3 == 0:
            w = edited(rnd, hot, rnd.randrange(0, 6))  # a third of the rows: near copies of one text
        else:
            w = passage + [f"w{rnd.randrange(10**6)}" for _ in range(rnd.randrange(10, 200))]
            if i % 3 == 2:
                w = edited(rnd, w, 2)
        texts[i * 7 + 3] = " ".join(w) if i % 2 else " ".join(w).upper()
    same(spark, texts)
    same(spark, texts, k=5, num=80)


@pytest.mark.parametrize("num", [80, 85])
def test_pigeonhole_holds_for_random_pairs(num):
    bands = jaccard.Bands(num, 100)
    rnd = np.random.default_rng(num)
    for n in [6, 7, 8, 9, 12, 17, 25, 40, 77, 150, 333, 1000, 4000]:
        for _ in range(25):
            a = rnd.integers(1, 1 << 63, n).astype(np.uint64)
            most = n * (100 - num) // num
            extra = int(rnd.integers(0, most + 1))  # b holds all of a and the most that still links
            b = np.concatenate([a, rnd.integers(1, 1 << 63, extra).astype(np.uint64)])
            assert 100 * len(a) >= num * len(b)
            assert set(bands.cell_keys(a).tolist()) & set(bands.cell_keys(b).tolist()), (n, extra)
            lost = int(rnd.integers(0, n * (100 - num) // 100 + 1))
            if 100 * (n - lost) >= num * n:
                assert set(bands.cell_keys(a).tolist()) & set(bands.cell_keys(a[lost:]).tolist()), (n, lost)


def test_shingles_of_a_slice():
    texts = ["", "a", "A b", "a b c d", "a b c d e", " a\tb\nc  d ", "x x x x x x"]
    key, offs = jaccard.shingles(pa.array(texts, pa.large_string()), 4)
    assert np.diff(offs).tolist() == [len(words(t, 4)) for t in texts]
    assert key[offs[3]] == key[offs[5]] and key[offs[3]] in key[offs[4]:offs[5]]


def test_awkward_rows(awkward, empty):
    rows = jaccard.join(awkward).collect()
    assert len(rows) == awkward.count()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append((r.n_shingles, r.component_id))
    assert by[2] == by[3] or {by[2][0][0], by[3][0][0], by[4][0][0]} == {0}
    assert [by[i][0][1] for i in (1, 2, 3, 4, 5, 6, 8)] == [1, 2, 3, 4, 5, 6, 8]
    assert len(by[6]) == 2 and by[None][0][1] is None
    assert jaccard.join(empty).count() == 0


def test_components_of_random_graphs(spark):
    rnd = random.Random(11)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)]
    edges += [(1000, 1000 + i) for i in range(1, 200)] + [(2000 + i, 2001 + i) for i in range(150)] + [(5, 5), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    want = {x: find(x) for x in list(root)}
    assert set(got) == set(want)
    pairs = {(got[x], want[x]) for x in want}
    assert len(pairs) == len(set(got.values())) == len(set(want.values()))


def test_every_link_of_a_group_is_counted(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4, raising=False)  # blocks of a component meet in pairs
    monkeypatch.setattr(jaccard, "COLUMNS", 32, raising=False)
    rnd = random.Random(11)
    texts = {}
    for n in (60, 90):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(n)]
        for _ in range(18):
            texts[len(texts)] = " ".join(edited(rnd, base, rnd.randrange(3)))
    texts |= {100: texts[0], 101: texts[0].upper(), 102: "alone in the world it is", 103: "alone in the world it is", 104: ""}
    sets = {i: words(t, 4) for i, t in texts.items()}
    want = {i: sum(1 for j, b in sets.items() if i != j and a and 100 * len(a & b) >= 85 * len(a | b)) for i, a in sets.items()}
    rows = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.n_links for r in jaccard.join(rows.union(rows.where("doc_id = 100"))).collect()}
    assert got == want and max(want.values()) > 2 and len(set(want.values())) > 4
