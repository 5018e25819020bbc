"""A poll's price of 0 has no log change: queries and their SQL agree on feeds that hold some."""

import os

import pytest

from marketloom.plans import registry
from tests.oracle import TABLES, run_sql, same

NAMES = ["o130_o142_poll_series", "o134_o241_decision_panel", "o143_resistance", "o171_library_moments", "o172_o173_box_matches"]


@pytest.fixture(scope="module")
def zeros(spark, tmp_path_factory):
    """The tables of sf0.01 with every 50th event's value 0."""
    out = tmp_path_factory.mktemp("zeros")
    for t in TABLES:
        os.symlink(f"/root/testdata/sf0.01/{t}.parquet", out / f"{t}.parquet")
    os.remove(out / "events.parquet")
    run_sql(f"COPY (SELECT * REPLACE (CASE WHEN event_id % 50 = 0 THEN 0 ELSE value END AS value) FROM events) TO '{out}/events.parquet'", "/root/testdata/sf0.01")
    return str(out)


@pytest.mark.parametrize("name", NAMES)
def test_zero_prices(spark, zeros, name):
    assert same(registry.QUERIES[name](spark, zeros), registry.ORACLES[name], zeros) > 0
