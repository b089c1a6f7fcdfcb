"""Every registered query against its SQL on the smallest data."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog import all_queries
from tools.check_queries import connect, difference

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@needs_data
@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_its_sql(spark, duck, name):
    ours = all_queries()[name](spark, FOLDER).toArrow()
    assert ours.num_rows > 0
    if name in oracle_sql():
        assert difference(ours, duck.sql(oracle_sql()[name]).to_arrow_table()) is None


@needs_data
def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


@needs_data
@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_query_uses_a_nested_loop_or_python(spark, name):
    plan = all_queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("NestedLoop", "CartesianProduct", "PythonUDF", "InPandas"))
