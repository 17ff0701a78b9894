"""Registered queries: names, oracles, columns; the pipeline's stages against plain code."""

import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from orrery.llm import queries as Q
from orrery.llm.common import stored
from tests.llm.test_jaccard import brute as components_of
from tests.llm.test_linededup import brute as lines_of

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "embeddings", "labels")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_one_query_for_each_operator():
    names = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_equals_its_sql(spark, con, name):
    df = Q.QUERIES[name](spark, SF)
    exp = con.execute(f"SELECT {', '.join(df.columns)} FROM ({Q.ORACLE[name]})").fetchall()
    assert sorted(map(tuple, df.collect()), key=str) == sorted(exp, key=str)
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {Q.ORACLE[name]}").fetchall()}
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR"}
    assert {c: names[t] for c, t in df.dtypes} == kinds


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = stored(P.STAGES[0][1](spark, docs, SF), "t")
    gone = docs.join(kept, "doc_id", "left_anti").collect()
    assert kept.columns == docs.columns and gone
    assert {labels.get(r.doc_id, 0) for r in gone} == {0} and {labels.get(r.doc_id, 1) for r in kept.collect()} == {1}
    lines = stored(P.STAGES[1][1](spark, kept, SF), "t")
    want = lines_of([(r.doc_id, r.source, r.text) for r in kept.collect()])
    assert sorted(((r.doc_id, r.text) for r in lines.collect()), key=str) == [(i, t) for i, t, _, _ in want]
    single = stored(P.STAGES[2][1](spark, lines, SF), "t")
    comp = components_of({r.doc_id: r.text for r in lines.collect()}, P.SHINGLE, P.NUM, P.DEN)
    assert {r.doc_id for r in single.collect()} == {c for _, c in comp.values()}
    mixed = stored(P.STAGES[3][1](spark, single, SF), "t")
    assert mixed.columns == docs.columns
    times = Counter(r.doc_id for r in mixed.collect())
    assert max(times.values()) <= 3 and set(times) <= {c for _, c in comp.values()}
    ids = P.STAGES[4][1](spark, mixed, SF)
    assert Counter(r.doc_id for r in ids.collect()) == times
    # the library's own run keeps the same documents
    assert Counter(r.doc_id for r in P.run(spark, SF).collect()) == times


def test_pipeline_takes_awkward_rows(spark, awkward, empty):
    for docs in (awkward, empty):
        docs = docs.select("doc_id", "text", "lang", "source", "score")
        for _, stage in P.STAGES[:-1]:
            out = stored(stage(spark, docs, SF), "t")
            assert out.columns == docs.columns
            docs = out
        P.STAGES[-1][1](spark, docs, SF).count()
