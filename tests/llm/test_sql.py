"""Queries of the llm subpackage against their SQL on the smallest tables."""

import pytest

from compare import connect, difference
from plazaflow.llm.oracles import ORACLES
from plazaflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert difference(spark, connect(FOLDER), name, FOLDER) is None
