"""Queries that SQL expresses, and row counts of the others."""

import pytest

import __spark_entry__ as entry
from compare import SF, connect, same
from hammerline.llm import registry


@pytest.mark.parametrize("key", sorted(registry.oracle_sql()))
def test_equals_sql(spark, key):
    same(registry.queries()[key](spark, SF), connect(), registry.oracle_sql()[key])


def test_registered():
    names = set(entry.queries())
    assert set(registry.queries()) <= names and "pipeline" in names
    assert [n for n in range(1, 14) if not any(k.startswith(f"op{n}_") for k in names)] == []
