"""All table queries against DuckDB at the smallest scale."""

import sys

import pytest

import __spark_entry__ as spark_entry

sys.path.insert(0, "tools")
from quillmill.plans.table_oracles import ORACLES  # noqa: E402
from quillmill.plans.table_queries import QUERIES  # noqa: E402
from tools.check import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF, name) is None


def test_entry(spark):
    rows = spark_entry.entry(spark)
    assert rows.columns == ["id", "text"] and rows.count() == 200


@pytest.mark.parametrize("name", ["paper_metadata_join", "positions", "sequence_ids", "new_only", "hydrate", "headings_once"])
def test_plans_have_no_pairwise_join_and_no_global_window(spark, name):
    plan = spark_entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert not any("Window" in line and "[]" in line for line in plan.splitlines())
