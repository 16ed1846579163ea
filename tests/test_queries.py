"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry_points
from oracle import connect, differences
from tidemart.plans.oracles import ORACLES
from tidemart.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, FOLDER), duck, ORACLES[name]) == ""


def test_entry_has_rows(spark):
    rows = entry_points.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"dt", "hr", "yesterday", "today"}
