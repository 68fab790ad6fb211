"""Operators against their SQL over a whole data folder."""

import pytest

from checks import compare
from gridmill.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    theirs = compare.sql_rows(compare.connect(DATA), ORACLES[name])
    assert compare.difference(compare.spark_rows(QUERIES[name](spark, DATA)), theirs) is None
