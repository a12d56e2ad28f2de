"""Every registered query against its SQL counterpart, on the smallest tables."""

import sys

import pytest
from conftest import ROOT

sys.path.insert(0, ROOT)

import __spark_entry__ as entry  # noqa: E402
from oracle_compare import connect, difference  # noqa: E402

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(TABLES)


# The queries of assayer.llm have tests of their own.
OWN = sorted(entry.rules.QUERIES | entry.suites.QUERIES)


def test_every_query_has_an_oracle():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(OWN) <= set(entry.oracle_sql())


def test_flagship(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and {"rule_id", "success", "unexpected_count"} <= set(df.columns)


@pytest.mark.parametrize("name", OWN)
def test_query(spark, database, name):
    assert difference(spark, database, name, entry.queries()[name], entry.oracle_sql()[name], TABLES) is None
