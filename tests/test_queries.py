"""Every named query against its SQL equivalent on the smallest tables."""

import pytest
from compare import difference

import __spark_entry__ as contract
from matchday.registry import Inputs, load

from .helpers import FOLDER

QUERIES = load()
WITH_SQL = [n for n, found in QUERIES.items() if found.sql]


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_sql(spark, duck, name):
    df = QUERIES[name].run(Inputs(spark, FOLDER))
    assert difference(df, duck, QUERIES[name].sql) is None


def test_contract(spark):
    # a subpackage may add queries of its own
    assert set(WITH_SQL) <= set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())
    assert contract.entry(spark).columns[:3] == ["game_id", "home_team", "away_team"]
