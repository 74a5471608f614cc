"""The registered queries of the operators: against their SQL, and by what their plans hold."""

import re

import pytest

import __spark_entry__ as contract
from check import compare

NATIVE = ["op2_line_dedup", "op3_license_scan", "op10_fingerprints"]


@pytest.mark.parametrize("name", sorted(contract.LLM_QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(spark, name, sf_dir) is None


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(spark, sf_dir, name):
    plan = contract.queries()[name](spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_no_query_pairs_rows_without_a_key(spark, sf_dir):
    for name in contract.LLM_QUERIES:
        plan = contract.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
