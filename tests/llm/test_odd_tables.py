"""Every query of the subpackage over empty tables and over nulls, repetitions, ties, long texts and clashing names."""

import pytest

from strophe.llm import registry


@pytest.mark.parametrize("kind", ["empty", "odd"])
@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_odd_tables(spark, odd_tables, name, kind):
    rows = registry.queries()[name](spark, odd_tables[kind]).collect()
    assert kind == "odd" or not rows


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, small, name):
    from tests.oracle import assert_same

    assert_same(spark, small, registry.queries()[name], registry.oracle_sql()[name])
