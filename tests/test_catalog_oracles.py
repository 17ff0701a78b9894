"""Every registered query with an oracle equals its DuckDB SQL at sf0.001 (the driver's check, smaller)."""

import math

import duckdb
import pytest
from pyspark.sql import types as T

import __spark_entry__ as E
from orrery.plans.tables import TABLES

SF = "/root/testdata/sf0.001"
ORACLES = E.oracle_sql()
DUCK_TYPE = {T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.DoubleType: "DOUBLE", T.StringType: "VARCHAR"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(cols)
    idx = [cols.index(c) for c in order]
    return sorted((tuple(_norm(r[i]) for i in idx) for r in rows),
                  key=lambda t: tuple((0, "") if x is None else (1, str(x)) for x in t))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    dtypes = {r[0]: r[1] for r in con.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    for f in sdf.schema.fields:
        assert DUCK_TYPE.get(type(f.dataType), str(f.dataType)) == dtypes[f.name], (f.name, f.dataType)
    got, exp = _rows(sdf.columns, [tuple(r) for r in sdf.collect()]), _rows(dcols, drows)
    assert len(got) == len(exp)
    for a, b in zip(got, exp):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                assert abs(x - y) <= 2e-5, (a, b)
            else:
                assert x == y, (a, b)
