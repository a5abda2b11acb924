"""Text queries against their SQL counterparts."""

import pytest
from conftest import SF
from oracle import connect, differences

from wattline.llm.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) == []


def test_one_query_for_each_operator():
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted([*(f"op{i}" for i in range(1, 14)), "pipeline"])
