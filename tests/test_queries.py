"""Every query with SQL against DuckDB, every other for rows and schema."""

import importlib
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from marketloom.plans import registry  # noqa: E402
from tests.oracle import same  # noqa: E402


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, name):
    df = registry.QUERIES[name](spark, sf)
    if name in registry.ORACLES:
        same(df, registry.ORACLES[name], sf)
    else:
        assert df.columns and df.count() >= 0


def test_entry(spark):
    entry = importlib.import_module("__spark_entry__")
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
