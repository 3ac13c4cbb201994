"""Driver contract: entry runs on sf0.001; every SQL key has a query."""

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 12
    assert set(df.columns) == {"model", "target", "n", "MAE", "RMSE", "R2", "MAPE"}


def test_oracle_keys_are_queries():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 120
