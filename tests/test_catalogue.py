"""Every catalogue query against its SQL, over the smallest tables."""

from __future__ import annotations

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from layercake.plans.catalogue import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = queries()[name](spark, FOLDER)
    assert differences(df, oracle_sql()[name], con) == []


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).columns[0] == "year"
