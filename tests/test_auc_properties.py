"""Property test: exact AUC equals the pairwise definition on random tied scores (Hypothesis)."""

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from orrery.operators import auc as au

from .test_auc import brute_auc

rows = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 1), st.integers(0, 8)), min_size=1, max_size=60)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_exact_auc_equals_pairwise_definition(spark, data):
    pdf = pd.DataFrame(data, columns=["g", "y", "s"])
    pdf["p"] = pdf["s"] / 8.0                                   # few distinct scores: many ties
    got = {r["g"]: r["auc"] for r in au.auc_exact(spark.createDataFrame(pdf[["g", "y", "p"]]), ["g"],
                                                  num_partitions=3).collect()}
    for g, grp in pdf.groupby("g"):
        exp = brute_auc(grp["y"].tolist(), grp["p"].tolist())
        assert (got[g] is None) if exp is None else got[g] == pytest.approx(exp, abs=1e-12)
