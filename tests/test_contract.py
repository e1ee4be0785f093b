"""Every named query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import compare

import __spark_entry__ as contract
from millrace.plans.oracle import ORACLE
from millrace.plans.registered import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return compare.database(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 30


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    same, note = compare.compare(spark, database, name, SMALL)
    assert same, note
