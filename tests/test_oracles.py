"""Every query against its SQL twin on the smallest sample."""

import compare
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from buildlens.oracles import ORACLES
from buildlens.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, con, name):
    assert compare.differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == ""
