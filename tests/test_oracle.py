"""Every registered query against its SQL twin."""

import os
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = contract.queries()
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for name in contract.TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return db


def freeze(value):
    if isinstance(value, list):
        return tuple(freeze(v) for v in value)
    if isinstance(value, Decimal):
        return float(value)
    return value


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(freeze(row[i]) for i in order) for row in rows)


def test_every_query_has_a_twin():
    """Those of training-data operators have none where SQL can't express them; tests/llm holds these."""
    assert set(ORACLE) <= set(QUERIES)
    assert {n for n in set(QUERIES) - set(ORACLE) if not n.startswith("op")} <= {"pipeline"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, duck, name):
    ours = QUERIES[name](spark, SF_DIR)
    theirs = duck.execute(ORACLE[name])
    columns = [d[0] for d in theirs.description]
    assert sorted(ours.columns) == sorted(columns)
    mine = as_bag(ours.columns, ours.collect())
    want = as_bag(columns, theirs.fetchall())
    assert sum(mine.values()) == sum(want.values())
    assert mine == want


def test_flagship(spark):
    rows = contract.entry(spark).collect()
    assert [(r["table"], r["diff"], r["status"]) for r in rows] == [("lineitem", 0, "match")]
