"""Every registered query against its SQL, at the scale the driver compares, and those
that compare with thresholds on the smallest tables too, where values lie exactly on them.
"""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from catalog.oracle import oracle_sql
from catalog.queries import queries
from tests.compare import connect, differences

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
QUERIES, SQL = queries(), oracle_sql()
FOREST = ("iforest_scores", "detect_flags_with_forest")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_all_queries_have_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert differences(got, con.execute(SQL[name]).df()) is None


@pytest.mark.parametrize("name", ["detect_flags", "risk_levels", "messages", "cooldown"])
def test_values_on_a_threshold(spark, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    assert differences(got, connect(SMALL).execute(SQL[name]).df()) is None


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", FOREST)
def test_forest_query_is_repeatable(spark, name):
    first = QUERIES[name](spark, SF).toPandas()
    assert len(first) > 0
    assert differences(first, QUERIES[name](spark, SF).toPandas()) is None
