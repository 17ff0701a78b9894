"""Targets by the stated rounds; what is taken comes near; times follow the schedules."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from orrery.llm import mixing
from orrery.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def rounds(size):
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {n: 1 + i % 3 for i, n in enumerate(names)}
    out, left, free = {}, sum(size.values()), set(names)
    while free:
        level = left / sum(weight[n] for n in free)
        over = [n for n in free if level * weight[n] > 3 * size[n]]
        if not over:
            return out | {n: level * weight[n] for n in free}
        for n in over:
            out[n] = 3 * size[n]
            left -= out[n]
            free.discard(n)
    return out


def plan(spark, rows):
    return mixing.plan(spark.createDataFrame(rows, "__key long, __source string, __size long")).collect()


@pytest.mark.parametrize("size", [
    {"a": 10, "b": 1000, "c": 5, "d": 2000, None: 30}, {"a": 100}, {"a": 0, "b": 7}, {"é": 50, "z": 50, "Z": 50, "𐀀": 50},
    {"a": 1, "b": 1, "c": 10_000},
])
def test_targets(spark, size):
    rows, k = [], 0
    for s, n in size.items():
        for _ in range(10):
            rows.append((k, s, n))
            k += 1
    got = plan(spark, rows)
    want = rounds({s: 10 * n for s, n in size.items()})
    took = Counter()
    for r in got:
        assert r.target == pytest.approx(want[r["__source"]]) and r.source_size == 10 * size[r["__source"]]
        assert r.copies <= 3 and len(r.times) == r.copies and all(0 <= t <= 1 for t in r.times)
        took[r["__source"]] += r.copies * r["__size"]
    for s, n in size.items():
        assert abs(took[s] - want[s]) <= n / 2 + 1e-6


def test_whole_table_comes_near_and_repeats(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op6_mixing"](spark, SF).collect()
    assert sorted(got) == sorted(QUERIES["op6_mixing"](spark, SF).collect())
    size, took, target = Counter(), Counter(), {}
    for r in got:
        s = docs[r.doc_id].source
        assert r.size == len(docs[r.doc_id].text.split())
        size[s] += r.size
        took[s] += r.taken
        target[s] = r.target
        assert r.taken <= 3 * r.size
    assert target == pytest.approx(rounds(size))
    assert max(abs(took[s] - target[s]) / target[s] for s in size) < 0.03


def test_hot_source_over_many_partitions(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", 1 + i % 50) for i in range(6000)]
    took, target = Counter(), {}
    for r in plan(spark, rows):
        took[r["__source"]] += r.copies * r["__size"]
        target[r["__source"]] = r.target
    assert max(abs(took[s] - t) for s, t in target.items()) <= 50


def test_a_hot_null_source_over_many_partitions(spark):
    rows = [(i, None if i % 3 else f"s{i % 7}", 1 + i % 50) for i in range(6000)]
    one = plan(spark, rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as many ranges as the session has
    try:
        got = plan(spark, rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    took, target = Counter(), {}
    for r in got:
        took[r["__source"]] += r.copies * r["__size"]
        target[r["__source"]] = r.target
    assert max(abs(took[s] - t) for s, t in target.items()) <= 50
    assert {r["__key"]: r for r in got} == {r["__key"]: r for r in one}


def test_times_follow_the_density(spark):
    got = plan(spark, [(i, f"s{i % 4}", 10) for i in range(4000)])
    by = defaultdict(list)
    for r in got:
        by[r["__source"]] += r.times
    src = {r["__s"]: r["__lean"] for r in mixing.targets(spark.createDataFrame(
        [(i, f"s{i}", 10) for i in range(4)], "__key long, __source string, __size long")).collect()}
    for s, times in by.items():
        half = sum(t < 0.5 for t in times) / len(times)
        assert half == pytest.approx(0.5 - src[s] / 4, abs=0.01)  # integral of 1 + a (2 t - 1) up to 0.5


def test_mix_of_the_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 300")
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    narrow = mixing.sizes(docs.select(F.xxhash64(*docs.columns).alias("__key"), F.col("source").alias("__source"), "text"))
    want = sum(r.copies for r in mixing.plan(narrow).collect())
    assert out.count() == want
    assert set(out.select("doc_id", "text").collect()) <= set(docs.select("doc_id", "text").collect())


def test_awkward_rows(spark, awkward, empty):
    docs = awkward.select("doc_id", "text", "lang", "source", "score", "target")
    out = P.mix(spark, docs, SF)
    assert out.columns == docs.columns
    assert all((r.text or "").strip() for r in out.collect())
    rows = mixing.plan(mixing.sizes(awkward.selectExpr("doc_id as __key", "source as __source", "text"))).collect()
    assert len(rows) == awkward.count()
    assert P.mix(spark, empty.select("doc_id", "text", "lang", "source"), SF).count() == 0


def test_the_query_reads_its_take_off_the_mix(spark, tmp_path, monkeypatch):
    rows = [(i, f"s{i % 3}" if i % 7 else None, "w " * (i % 11)) for i in range(60)]
    rows += [(7, "s1", "w w w"), (7, "s1", "w w w"), (None, "s0", "w w"), (90, "w", None), (90, None, "w")]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(path)
    got = QUERIES["op6_mixing"](spark, str(tmp_path)).collect()
    docs = mixing.sizes(spark.read.parquet(path).selectExpr("doc_id as __key", "source as __source", "text"))
    times = sorted(t for r in mixing.plan(docs).collect() for t in r.times)
    assert len(got) == len(rows) and sum(r.copies for r in got) == len(times)
    assert all(r.taken == r.copies * r.size for r in got)
    assert all(r.first_time == times[r.first_place - 1] if r.copies else r.first_place is None for r in got)
    whole = mixing.curriculum
    monkeypatch.setattr(mixing, "curriculum", lambda *a: whole(*a).where("__time < 0.5"))
    early = QUERIES["op6_mixing"](spark, str(tmp_path)).collect()
    assert sum(r.copies for r in early) == sum(t < 0.5 for t in times)
