"""Registered streams in a session that leaves the state store at Spark's default, against their SQL."""

import duckdb
import pytest
from test_entry import canonical

from rivulet.plans import oracles, queries

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
DEFAULT = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


@pytest.fixture(scope="module", params=["full", "odd"])
def events(request, tmp_path_factory):
    """Events; the odd ones have some without a time, and some without a user."""
    ts, user = ("case when i % 23 > 0 then ts end", "case when i % 19 > 0 then user_id end") if request.param == "odd" else ("ts", "user_id")
    folder = tmp_path_factory.mktemp("events")
    duckdb.sql(
        f"""copy (
          select event_id, {ts} as ts, {user} as user_id, event_type, value from (
          select i, i as event_id, timestamp '2024-01-01' + to_seconds(i * 97) as ts, i * 7 % 11 as user_id,
            ['click', 'view', 'signup', 'purchase', 'error'][i * 13 % 17 % 5 + 1] as event_type,
            cast(i * 37 % 101 as double) + 0.25 as value
          from range(240) r(i))
        ) to '{folder}/events.parquet' (format parquet)"""
    )
    return str(folder)


@pytest.mark.parametrize("name", ["neighbor_mean_streamed", "enrich_stream_bounded", "arima_forecast_streamed"])
def test_stream(spark, events, name):
    session = spark.newSession()
    session.conf.set(PROVIDER, DEFAULT)
    got = queries.queries()[name](session, events).toPandas()
    with duckdb.connect() as connection:
        connection.execute(f"create view events as select * from '{events}/events.parquet'")
        want = connection.sql(oracles.ORACLES[name]).df()
    assert len(want) > 0
    assert canonical(got) == canonical(want)
