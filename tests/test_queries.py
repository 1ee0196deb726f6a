"""Every query of the library against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, difference
from plazaflow.plans.oracles import ORACLES
from plazaflow.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    before = set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    assert difference(spark, con, name, FOLDER) is None
    assert set(spark.sparkContext._jsc.getPersistentRDDs().keySet()) <= before
