"""Every query gives what its SQL gives on the same tables."""

from __future__ import annotations

import pytest
from oracle import difference

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", [name for name in QUERIES if name in SQL])
def test_same_as_sql(spark, sf, name):
    assert difference(QUERIES[name](spark, sf), SQL[name], sf) is None


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
