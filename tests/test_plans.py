"""Plan shape: filters and projections reach the Parquet scans."""

import os

import pytest

from panelforge.plans import catalog as Q

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_active_filter_pushed_to_scan(spark):
    plan = _plan(Q.REGISTRY["filter_active_entities"](spark, SF))
    assert "GreaterThan(c_acctbal,0.0)" in plan


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_lineitem_scan_is_pruned(spark):
    plan = _plan(Q.REGISTRY["create_targets_supplier_year"](spark, SF))
    scans = [line for line in plan.splitlines() if "ReadSchema" in line and "lineitem" in line]
    assert scans, plan
    schema = scans[0].split("ReadSchema:")[1]
    assert "l_comment" not in schema and "l_extendedprice" not in schema and "l_suppkey" in schema
