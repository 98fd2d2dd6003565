"""Registered queries against their SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from orebed.catalog import all_oracles, all_queries
from check_oracles import compare, connect

SF = "/root/testdata/sf0.001"
SLOW = ("c12_", "c3_", "d_four", "c19_", "f8_")  # minutes each: run by check_oracles.py only


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in all_queries() if not n.startswith(SLOW)])
def test_query(spark, con, name):
    assert compare(spark, con, SF, name, all_queries()[name], all_oracles().get(name)) is None


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
