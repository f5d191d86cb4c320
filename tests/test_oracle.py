"""Every registered query with a SQL equivalent, at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from aerostrata.plans.oracle import all_oracles
from tests.compare import compare

ORACLES = all_oracles()


def test_registry():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    assert compare(spark, duck, "/root/testdata/sf0.001", name, queries()[name], ORACLES[name]) in ("", "EMPTY")
