"""Every registered query beside its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import differences, oracle
from dialwright.examples import catalog

@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle(sf_dir)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql())))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert differences(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


def test_entry_returns_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
