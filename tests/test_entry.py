"""The driver contract module."""

import importlib


def test_entry_runs_on_smoke_scale(spark):
    entry = importlib.import_module("__spark_entry__")
    df = entry.entry(spark)
    assert df.columns == ["campaign_id", "name", "CLICKED", "OPENED", "effectiveness"]
    assert df.count() > 0
    from inboxlens.plans import catalog, oracle
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
