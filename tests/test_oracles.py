"""Every registered query against its oracle on the smallest tables."""

import pytest
from compare import connect, mismatch

from textloom.plans import registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_matches_oracle(spark, database, name):
    assert mismatch(spark, database, SF_DIR, registry.queries()[name], registry.oracles().get(name)) is None


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracles())


def test_no_stream_is_left_running(spark):
    assert spark.streams.active == []


def test_entry_is_the_flagship(spark):
    import __spark_entry__ as driver

    assert set(driver.queries()) >= set(registry.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).columns[:2] == ["split", "lang"]
