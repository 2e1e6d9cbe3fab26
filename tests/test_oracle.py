"""Registered queries against their SQL, on the smallest tables.

Many of them train the same models. In these tests a training with the same corpora and
settings runs once and its written tables are read again.
"""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import compare  # noqa: E402

import __spark_entry__ as contract  # noqa: E402

from tamis.catalog import queries as Q  # noqa: E402
from tamis.plans import select as P  # noqa: E402


@pytest.fixture(scope="module", autouse=True)
def trained_once():
    """``train_models`` that remembers, by the plans of the corpora and the parameters."""
    train, known = P.train_models, {}

    def remembered(general, specific, sides, sample="first", settings=P.Settings()):
        key = (general.semanticHash(), specific.semanticHash(), tuple(sides), sample, settings)
        if key not in known:
            known[key] = train(general, specific, sides, sample, settings)
        return known[key]

    P.train_models = remembered
    yield
    P.train_models = train


def test_every_query_has_sql():
    assert Q.QUERIES.keys() == Q.SQL.keys()
    assert Q.QUERIES.keys() <= contract.queries().keys()


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["rank", "score", "seg_id", "src", "tgt"]
    assert rows.count() > 0


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, smallest, name):
    connection = compare.connect(smallest)
    df = Q.QUERIES[name](spark, smallest)
    assert compare.difference(df, Q.SQL[name], connection) is None


if __name__ == "__main__":
    import time

    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    sf_dir, only = sys.argv[1], sys.argv[2:]
    database = compare.connect(sf_dir)
    wrong = 0
    for name, sql in contract.oracle_sql().items():
        if only and name not in only:
            continue
        start = time.time()
        found = compare.difference(contract.queries()[name](session, sf_dir), sql, database)
        wrong += found is not None
        print(f"{name}: {found or 'equal'} ({time.time() - start:.1f} s)", flush=True)
    sys.exit(1 if wrong else 0)
