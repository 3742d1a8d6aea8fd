"""Every registered query against its SQL twin, strictly: names, types, rows and values."""
from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from compare import compare
from regulus import plans

QUERIES = plans.QUERIES
ORACLES = plans.oracles()


def test_every_twin_has_its_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert not entry_module.entry(spark).isEmpty()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        assert compare(df, duck, ORACLES[name]) is None
    else:
        assert df.count() > 0
