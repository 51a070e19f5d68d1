"""Registered queries: against SQL where there is some, else whole rows of the right shape."""

from __future__ import annotations

import pytest
from compare import connect, differences

from __spark_entry__ import oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
NAMES = [n for n in queries() if n.startswith("op")]


@pytest.mark.parametrize("name", [n for n in NAMES if n in oracle_sql()])
def test_against_sql(spark, name):
    assert differences(queries()[name](spark, FOLDER), oracle_sql()[name], connect(FOLDER)) == []


def test_every_operator_is_there():
    assert [n.split("_")[0] for n in NAMES] == [f"op{i}" for i in range(1, 14)]


def test_pipeline(spark):
    made = queries()["pipeline"](spark, FOLDER)
    rows = made.collect()
    assert rows and all(r.n_tokens * 4 == len(r.ids) for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows)
