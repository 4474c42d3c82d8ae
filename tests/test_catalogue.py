"""Every registered query gives the rows of its SQL on the same tables."""

import pytest
from compare import check

import __spark_entry__ as contract
from benchloom.catalogue import ENTRIES


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query_equals_sql(spark, con, name):
    difference, _, _, _ = check(spark, con, name)
    assert difference is None


def test_every_query_has_sql():
    assert set(ENTRIES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
