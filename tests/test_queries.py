"""Every registered query beside its SQL check, on the smallest tables."""

import pytest

import __spark_entry__ as E
from corpora.compare import connect, differences
from corpora.queries import CHECKS, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["path", "file_name", "report"] and df.count() == 50


def test_registry():
    assert set(QUERIES) <= set(E.queries())
    assert set(CHECKS) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    # One check selects rows that the smallest tables may lack.
    found = [d for d in differences(spark, con, SF, name) if d != "check has no rows"]
    assert found == []
