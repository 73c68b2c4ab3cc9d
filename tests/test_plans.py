"""Plan-shape checks: no Python UDF in any registered query, no cartesian
product, scans prune columns."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

QUERIES = E.queries()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_no_cartesian(spark, name):
    p = _plan(QUERIES[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "CartesianProduct" not in p


def test_scan_prunes_columns(spark):
    p = _plan(QUERIES["vw_sla_monthly"](spark, SF_SMALL))
    assert "l_extendedprice" not in p and "c_acctbal" not in p
