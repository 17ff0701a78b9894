"""Counts by brute force, quantiles against sorted values, thresholds by group."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orrery.llm import rules

SF = "/root/testdata/sf0.01"


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    three = Counter(zip(w, w[1:], w[2:], strict=False))
    held = {j for i in range(len(w) - 2) if three[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(held)


def test_counts_of_whole_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rules.judge(docs).collect():
        e = counts(texts[r.doc_id])
        assert tuple(r[1:6]) == e
        assert r.base_failed == (e[0] < 50 or 100 * e[4] > 50 * e[0]) and (not r.base_failed or not r.kept)


def test_clean_documents_stay_and_symbols_go(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = rules.judge(spark.read.parquet(f"{SF}/documents.parquet")).join(labels, "doc_id").where("not base_failed").collect()
    good, bad = [r.kept for r in got if r.quality == 1], [r.kept for r in got if r.quality == 0]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.1


def quartiles(weights):
    """Smallest values at or above a quarter and three quarters of the weight."""
    total, upto, out = sum(w for _, w in weights), 0.0, []
    marks = [0.25, 0.75]
    for v, w in sorted(weights):
        upto += w
        while marks and upto >= marks[0] * total * (1 - 1e-9):
            out.append(v)
            marks.pop(0)
    return out


def leaning(values, around):
    """Values of weight 1, and PRIOR documents spread as the weighted values around."""
    total = sum(w for _, w in around)
    return [(v, 1.0) for v in values] + [(v, rules.PRIOR * w / total) for v, w in around]


def test_fences_against_sorted_values_and_merge_exactly(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang in ('en', 'es') and source in ('src0', 'src1', 'src2')")
    docs = docs.where("not (lang = 'es' and source = 'src2' and doc_id % 5 > 0)")
    m = rules.measure(docs).cache()
    rows = [tuple(r) for r in m.select("__lang", "__source", rules.ratios()["length"]).collect()]
    got = {(r["__lang"], r["__source"]): r for r in rules.fences(rules.sketch(m)).collect()}
    assert len(got) >= 5
    whole = [(v, 1.0) for _, _, v in rows]
    for (lang, source), r in got.items():
        of_lang = leaning([v for x, _, v in rows if x == lang], whole)
        q1, q3 = quartiles(leaning([v for x, y, v in rows if (x, y) == (lang, source)], of_lang))
        reach = max(rules.SLACK["length"], 3 * (q3 - q1))
        assert r.high_length == pytest.approx(q3 + reach, rel=0.03) and r.low_length == pytest.approx(q1 - reach, abs=0.3)
    halves = [rules.sketch(m.where(F.col("doc_id") % 2 == i)) for i in (0, 1)]
    assert sorted(map(tuple, rules.fences(halves[0].union(halves[1])).collect())) == sorted(map(tuple, got.values()))


def test_awkward_rows(awkward, empty):
    rows = rules.judge(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id in (2, 3, 4))
    texts = {r.doc_id: r.text for r in awkward.collect()}
    assert all(tuple(r[1:6]) == counts(texts[r.doc_id]) for r in rows)
    assert rules.judge(empty).count() == 0
