"""Every registered batch query equals its DuckDB oracle on the sf0.001 tables
(the driver's gate runs the same comparison at sf0.01)."""

import collections

import duckdb
import pytest

import __spark_entry__ as entry
from opsframe.sources.roles import BASE_TABLES
from scripts.oracle_check import norm
from tests.conftest import SF

NAMES = [n for n in entry.oracle_sql() if not n.startswith("stream_")]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def bag(pdf):
    cols = sorted(pdf.columns)
    return collections.Counter(tuple(norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert bag(got) == bag(want)
