"""The driver contract in __spark_entry__.py."""

import importlib


def test_entry_contract(spark):
    entry = importlib.import_module("__spark_entry__")
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"year", "round", "driver", "team", "race_avg_lap", "start_grid"} <= set(df.columns)
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert "driver_race_features" in o
