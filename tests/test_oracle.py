"""Every registered query against its SQL on the smallest tables."""

import compare
import pytest

from __spark_entry__ import entry
from tierline.registry.oracle import ORACLES
from tierline.registry.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return compare.duck(SF)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    assert compare.differences(QUERIES[name](spark, SF), connection, ORACLES[name]) == []


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
