"""Near words, forms and roots by brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from orrery.llm import variants
from orrery.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def vocabulary(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode()) if i is not None else 1
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def brute(rows):
    n = vocabulary(rows)
    shape = {}
    for w in n:  # words one edit apart share a word without one letter, or are one another's
        for key in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            shape.setdefault(key, set()).add(w)
    near = {w: set() for w in n}
    for group in shape.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda b: (-n[b], b), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w
    return {(w, form[w], root(w), c, len(near[w]), n.get(form[w])) for w, c in n.items()}


def run(spark, rows, **kw):
    got = variants.variants(spark.createDataFrame(rows, "doc_id long, text string"), **kw)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    out = [tuple(r) for r in got.collect()]
    assert len(set(out)) == len(out)
    return set(out)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {tuple(r) for r in QUERIES["op12_variants"](spark, SF).collect()}
    assert got == brute(rows) and any(f for _, f, *_ in got)


@pytest.mark.parametrize("symbols", [1, 2, 8])
def test_random_words_over_few_letters(spark, symbols):
    rnd = random.Random(symbols)
    pool = ["".join(rnd.choice("abÉéZz÷") for _ in range(rnd.randint(6, 9))) for _ in range(60)]
    pool += [w[:i] + rnd.choice("abz") + w[i + d:] for w in pool for i, d in [(rnd.randint(0, len(w)), rnd.randint(0, 1))]]
    rows = [(i, " ".join(rnd.choices(pool, [1 / (k + 1) for k in range(len(pool))], k=60))) for i in range(60)]
    assert run(spark, rows, symbols=symbols) == brute(rows)


def test_chains_ties_and_case(spark):
    rows = [(11, "Kolibri_ " * 3 + "kolibri " * 400), (2, "kolibra " * 30), (3, "kolibrx " * 2),
            (4, "kolibrax " * 2), (5, "KOLIBRIÉ kolibrié"), (6, None), (None, "kolibrié!"), (7, "")]
    got = run(spark, rows)
    assert got == brute(rows)
    assert ("kolibrax", "kolibra", "kolibri") in {r[:3] for r in got}


def test_very_long_words(spark):
    long = "ab" * 4_000
    rows = [(1, f"{long} {long}"), (None, f"{long}x {long}x kurzwort"), (2, "kurzwort")]
    got = run(spark, rows)
    assert {(len(r[0]), r[4]) for r in got} == {(len(w), 1 if len(w) > 9 else 0) for w in vocabulary(rows)}


def test_neighbourhoods_are_whole_and_without_repeats():
    codes = np.array([[1, 1, 2, 3], [3, 2, 2, 2]], np.uint64)
    got = [[], []]
    for row, form in variants._neighbours(codes, 3):
        for r, f in zip(row.tolist(), form.tolist()):
            got[r].append(f)
    for word, forms in zip(codes.tolist(), got):
        want = {tuple(word)} | {tuple(word[:i] + word[i + 1:]) for i in range(4)}
        want |= {tuple(word[:i] + [s] + word[i + d:]) for s in (1, 2, 3) for d in (0, 1) for i in range(5 - d)}
        want = {int(variants._form(np.array([w], np.uint64))[0]) for w in want}
        assert len(forms) == len(want) and set(forms) == want


def test_awkward_rows(spark, awkward, empty):
    got = {tuple(r) for r in variants.variants(awkward).collect()}
    assert got == brute([(r.doc_id, r.text) for r in awkward.collect()])
    assert variants.variants(empty).count() == 0
