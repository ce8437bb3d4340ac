"""Every query against its SQL counterpart over the whole given tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as spark_entry
import parity
from rosterlake.plans import oracle, queries

ORACLE = oracle.oracle_sql()
QUERIES = queries.QUERIES


@pytest.fixture(scope="module")
def con(folder):
    connection = parity.connect(folder)
    yield connection
    connection.close()


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(spark_entry.queries()) and set(ORACLE) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_result(spark, folder, con, name):
    parity.assert_same(QUERIES[name](spark, folder), con, ORACLE[name])


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns[0] == "burnout_fact_id"
    assert df.count() > 0
