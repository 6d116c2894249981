"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry_module
from compare import connect, differences
from parley.plans.oracles import ORACLES
from parley.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_entry_has_rows(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["window_start", "window_end", "reference", "count"]
    assert df.limit(1).count() == 1
