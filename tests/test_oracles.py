"""Every query with a SQL counterpart returns exactly its rows."""

import pytest

from checks import compare
from checks.oracles import ORACLES
from checks.queries import QUERIES
from tests.conftest import DATA


@pytest.fixture(scope="module")
def con():
    return compare.connect(DATA)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    ours = compare.spark_rows(QUERIES[name](spark, DATA))
    assert compare.difference(ours, compare.sql_rows(con, ORACLES[name])) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert entry.oracle_sql()["daily_total_energy"] == ORACLES["daily_total_energy"]
    assert entry.entry(spark).columns[0] == "date"
