"""Driver contract: the flagship query runs and the registry is consistent."""

import __spark_entry__ as entry


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert "status" in df.columns and df.count() > 0


def test_registry_consistent():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert len(qs) >= 60
    assert set(sql) <= set(qs)
    assert all(callable(f) for f in qs.values())
