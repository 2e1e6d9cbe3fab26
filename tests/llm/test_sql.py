"""Registered queries of the subpackage against their SQL, on the smallest tables."""

import compare
import pytest

import __spark_entry__ as contract
from tamis.llm.queries import QUERIES
from tamis.llm.sql import SQL


def test_registered():
    assert QUERIES.keys() <= contract.queries().keys() and SQL.keys() <= QUERIES.keys()
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)} | {"pipeline"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, smallest, name):
    df = QUERIES[name](spark, smallest)
    assert compare.difference(df, SQL[name], compare.connect(smallest)) is None
