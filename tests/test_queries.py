"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as contract
from check_oracles import compare, duck
from sluice.queries import all_queries, all_sql

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, SF_DIR, name, QUERIES[name], SQL.get(name))
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_names():
    assert not [n for n in QUERIES if n == "pipeline" or re.match(r"op\d", n)]


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["doc_id", "lang", "clean_prob", "op1", "op2"]
    assert df.count() > 0
