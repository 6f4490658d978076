"""Every registered query against the SQL that states the same result."""

import ast
import os

import oracle
import pytest

import __spark_entry__ as entry_points

# The training-data queries have tests of their own.
OWN = {n for m in entry_points.MODULES if ".llm" not in m.__name__ for n in m.QUERIES}
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def sql_engine():
    return oracle.connect(SF)


def test_each_query_has_its_sql():
    assert OWN <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_equals_sql(spark, sql_engine, name):
    found = oracle.spark_rows(QUERIES[name](spark, SF))
    wanted = oracle.sql_rows(sql_engine, SQL[name])
    assert found[0] == wanted[0]
    assert len(found[1]) == len(wanted[1]) > 0
    assert found[1] == wanted[1]


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() == 6


def test_operators_start_no_session():
    root = os.path.join(os.path.dirname(entry_points.__file__), "millrace")
    for folder, _, names in os.walk(root):
        for name in names:
            if name.endswith(".py"):
                tree = ast.parse(open(os.path.join(folder, name)).read())
                attributes = {n.attr for n in ast.walk(tree) if isinstance(n, ast.Attribute)}
                assert not attributes & {"builder", "getOrCreate", "localCheckpoint"}, name
