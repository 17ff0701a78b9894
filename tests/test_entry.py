"""Driver contract: entry runs, every oracle has a query."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert set(df.columns) == {"split", "task", "auc_exact", "auc_binned", "n_pos", "n_neg"}


def test_oracles_have_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50
