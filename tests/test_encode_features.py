"""Encodings, buckets, statistics."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orrery.operators import encode as en
from orrery.operators import features as fe


def test_one_hot_and_out_of_range(spark):
    df = spark.createDataFrame([(0,), (2,)], "y int")
    assert [r[0] for r in df.select(en.one_hot("y", 3)).collect()] == [[1.0, 0.0, 0.0], [0.0, 0.0, 1.0]]
    with pytest.raises(Exception):
        spark.createDataFrame([(3,)], "y int").select(en.one_hot("y", 3)).collect()


def test_one_hot_nullable(spark):
    df = spark.createDataFrame([("a",), (None,), ("z",)], "c string")
    got = [r[0] for r in df.select(en.one_hot_nullable("c", ["a", "b"])).collect()]
    assert got == [[1.0, 0.0], [0.0, 0.0], [0.0, 0.0]]


def test_buckets(spark):
    days = [None, -1, 0, 1.9, 2, 3, 4, 5, 6, 6.99, 7, 30, 30.5, 365, 366]
    df = spark.createDataFrame([(None if d is None else float(d),) for d in days], "d double")
    r = df.select(en.los_bucket("d").alias("los"), en.survival_bucket("d").alias("surv")).collect()
    assert [x["los"] for x in r] == [None, None, 0, 0, 1, 2, 3, 4, 5, 5, 6, 6, 7, 7, 7]
    assert [x["surv"] for x in r] == [4, 4, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1, 2, 2, 3]


def test_variable_stats_against_pandas(spark):
    rng = np.random.default_rng(0)
    n = 2000
    ent = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 20, n))   # one hot entity
    pdf = pd.DataFrame({"e": ent, "var": rng.choice(["a", "b"], n), "id": np.arange(n),
                        "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.permutation(n), unit="h"),
                        "v": np.round(rng.normal(10, 3, n), 1)})
    df = spark.createDataFrame(pdf)
    got = fe.variable_stats(df, "e", "var", "ts", "v", tiebreak="id").toPandas().set_index(["e", "var"])
    for (e, var), grp in pdf.groupby(["e", "var"]):
        g = got.loc[(e, var)]
        srt = grp.sort_values(["ts", "id"])
        assert g["count"] == len(grp)
        assert g["median"] == pytest.approx(grp["v"].median())
        assert g["mean"] == pytest.approx(grp["v"].mean())
        assert g["first"] == srt["v"].iloc[0] and g["last"] == srt["v"].iloc[-1]
        hours = (grp["ts"] - pd.Timestamp("1970-01-01")).dt.total_seconds() / 3600
        assert g["slope"] == pytest.approx(np.polyfit(hours, grp["v"], 1)[0], rel=1e-6)
    approx = fe.variable_stats(df, "e", "var", "ts", "v", tiebreak="id", median="approx").toPandas()
    assert len(approx) == len(got)


def _hot_events(spark, n=3000):
    """A third of the rows in one group, ties in value and time, null values, null keys, a group without values."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        e = 0 if rng.random() < 0.34 else int(rng.integers(1, 30))
        v = None if i % 17 == 0 else float(np.round(rng.normal(), 1))
        rows.append((None if e == 29 else e, str(rng.choice(["a", "b"])), i, int(rng.integers(0, 50)), v))
    rows += [(77, "a", n + i, i, None) for i in range(3)] + [(78, "b", n + 9, 1, 2.5)]
    return spark.createDataFrame(rows, "e int, var string, id int, h int, v double").withColumn(
        "ts", F.timestamp_seconds(F.col("h") * 3600))


def _plain(df, keys):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


def test_groups_too_large_for_a_task_have_the_same_statistics(spark):
    ev = _hot_events(spark)
    for f in (lambda k: fe.variable_stats(ev, "e", "var", "ts", "v", "id", hot_rows=k),
              lambda k: fe.events_wide(ev, "e", "var", ["a", "b"], "ts", "v", "id", hot_rows=k)):
        want = _plain(f(10 ** 6), 2)
        assert len(want) > 30
        for hot_rows in (0, 40, 400):  # all, most, one of the groups
            assert _plain(f(hot_rows), 2) == want


def test_wide_events_equal_the_pivot_of_long_statistics(spark):
    ev = _hot_events(spark, 800).where("e is not null")
    long = fe.variable_stats(ev, "e", "var", "ts", "v", "id")
    cols = ["e", *[f"{v}_{s}" for v in ("a", "b") for s in fe.STATS]]
    assert _plain(fe.events_wide(ev, "e", "var", ["a", "b"], "ts", "v", "id").select(*cols), 1) == \
        _plain(fe.stats_wide(long, "e", "var", ["a", "b"]).select(*cols), 1)


def test_statistics_take_one_shuffle(spark, tmp_dir):
    _hot_events(spark, 300).write.parquet(f"{tmp_dir}/ev")
    out = fe.variable_stats(spark.read.parquet(f"{tmp_dir}/ev"), "e", "var", "ts", "v", "id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_wide_and_assemble(spark):
    stats = spark.createDataFrame([(1, "a", 3, 1.0), (2, "b", 2, 5.0)], "e int, var string, count long, mean double")
    w = fe.stats_wide(stats, "e", "var", ["a", "b"], ["count", "mean"]).orderBy("e")
    got = w.select("e", fe.assemble_features([fe.stats_array(["a", "b"], ["count", "mean"]), F.array(F.lit(9.0))],
                                             5)).collect()
    assert got[0][1] == [3.0, 1.0, 0.0, 0.0, 9.0] and got[1][1] == [0.0, 0.0, 2.0, 5.0, 9.0]
    with pytest.raises(Exception):
        w.select(fe.assemble_features([F.array(F.lit(1.0))], 2)).collect()


def test_select_group_and_squeeze(spark):
    df = spark.createDataFrame([(list(map(float, range(18))),)], "x array<double>")
    assert df.select(fe.select_group("x", 1, 9)).first()[0] == list(map(float, range(9, 18)))
    assert df.select(fe.squeeze_label(F.array(F.lit(7)))).first()[0] == 7


def test_statistics_do_not_depend_on_session_time_zone(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    utc = sorted(map(tuple, fe.variable_stats(ev, "user_id", "event_type", "ts", "value", "event_id").collect()))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        la = sorted(map(tuple, fe.variable_stats(ev, "user_id", "event_type", "ts", "value", "event_id").collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert utc == la


def test_rows_of_small_groups_are_shuffled_once_and_large_ones_as_partial_aggregates(spark, monkeypatch):
    from orrery.operators import features as fe
    rows = [(i // 3 if i % 10 else None, i, float(i * 7 % 13) if i % 4 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "g long, t long, x double").withColumn("t", F.timestamp_seconds("t"))

    def stats():
        out = fe.grouped_stats(df, ["g"], {"x": F.col("x"), "y": F.col("x") + 1}, "t")
        return out, {r[0]: tuple(round(v, 9) if isinstance(v, float) else v for v in r[1:]) for r in out.collect()}

    def plan(out):
        return out._jdf.queryExecution().sparkPlan().toString()

    few, a = stats()
    assert "REPARTITION_BY_COL" in plan(few)
    with monkeypatch.context() as m:
        m.setattr(fe, "FEW_ROWS", 0, raising=False)
        many, b = stats()
    assert "REPARTITION_BY_COL" not in plan(many) and a == b and len(a) == 101
