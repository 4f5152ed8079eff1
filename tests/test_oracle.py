"""Every registered query against its SQL twin, whole results, on the small tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect

D = "/root/testdata/sf0.001"
SLOW = {"l3_random_forest_grid", "l4_boosted_trees_on_vectors", "g11_bradley_terry_converged"}


@pytest.fixture(scope="module")
def con():
    return connect(D)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, D, name, entry.queries()[name], entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - SLOW))
def test_gives_rows(spark, name):
    assert entry.queries()[name](spark, D).count() > 0


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 200
