from __future__ import annotations

import pytest
from conftest import SMALL

import __spark_entry__ as contract
from checks.compare import connect, differences
from checks.oracle import oracle
from checks.queries import registered


def test_every_query_has_sql():
    assert registered().keys() == oracle().keys()
    assert registered().keys() <= contract.queries().keys() and oracle().keys() <= contract.oracle_sql().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_flagship(spark):
    assert contract.entry(spark).count() == 851


@pytest.mark.parametrize("name", registered())
def test_query_matches_its_sql(spark, name):
    assert differences(spark, connect(SMALL), SMALL, name) == []
