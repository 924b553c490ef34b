"""Registered queries against DuckDB on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as entry_point  # noqa: E402

from rivulet.plans import oracles, queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
# Forecast windows need more readings than the smallest table has.
LARGER_DIR = "/root/testdata/sf0.01"
QUERIES, ORACLES = queries.queries(), oracles.ORACLES

if not Path(SF_DIR).exists():
    pytest.skip("needs the test tables", allow_module_level=True)


def duck(sf_dir):
    connection = duckdb.connect(config={"threads": 1})
    connection.execute(f"create view events as select * from '{sf_dir}/events.parquet'")
    return connection


def canonical(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)]
    for name in df.columns:
        if str(df[name].dtype).startswith("datetime"):
            df = df.assign(**{name: df[name].astype("datetime64[us]").astype(str)})
    df = df.astype(object).where(df.notna(), None)
    return sorted(map(repr, df.itertuples(index=False, name=None)))


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert ORACLES.keys() <= entry_point.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    sf_dir = LARGER_DIR if name.startswith("arima") else SF_DIR
    got, want = QUERIES[name](spark, sf_dir).toPandas(), duck(sf_dir).sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(want) > 0
    assert canonical(got) == canonical(want)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
