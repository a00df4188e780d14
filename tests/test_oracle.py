"""Every registered query against its SQL on the smallest given tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in SQL:
        problem, _ = difference(df, duck, SQL[name])
        assert problem is None, problem
    else:
        assert df.count() >= 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    blocks = entry.entry(spark)
    assert {"split", "scope", "block_idx", "input_ids", "labels"} <= set(blocks.columns)
    assert blocks.where("size(input_ids) <> 256 OR labels <> input_ids").isEmpty()
