"""Driver contract: entry runs, every query has an oracle, names are unique."""

import __spark_entry__ as E
from squall.plans import standins


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["alert_date", "routeId", "entity_id", "temperature", "shortForecast"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(standins.QUERIES) == set(standins.ORACLES) <= set(E.oracle_sql())
