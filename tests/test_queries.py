"""Every registered query against its SQL twin."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as driver
from doselake import oracles, registry


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.database(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    got = registry.QUERIES[name](spark, sf_dir)
    assert compare.differences(got, con, oracles.oracle_sql()[name]) is None


def test_every_query_has_a_twin():
    assert set(registry.QUERIES) == set(oracles.oracle_sql())
    assert set(registry.QUERIES) <= set(driver.queries())


def test_entry(spark):
    row = driver.entry(spark).first()
    assert row["total_doses"] == 6000
    assert row["children"] + row["young_adults"] + row["adults"] + row["middle_aged"] + row[
        "seniors"
    ] == row["total_doses"]
