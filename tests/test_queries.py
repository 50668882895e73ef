"""Every registered query against its SQL, on the smallest tables, and a look at its plan."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from conftest import node_lines, plan_of
from verification.compare import connect, difference
from verification.oracle import ORACLE
from verification.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "MapInArrow", "Window")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = connect(FOLDER)
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


def test_all_queries_are_registered():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry_points.queries()[name](spark, FOLDER)
    nodes = node_lines(plan_of(df))
    if name.startswith("sequence_keys"):
        nodes = nodes.replace("Window", "")  # over one row per partition, see test_plans
    for word in FORBIDDEN:  # no pairwise joins, Python code or windows over whole tables
        assert word not in nodes
    assert difference(df, duck, entry_points.oracle_sql()[name]) is None
