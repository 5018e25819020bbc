"""Pockets are made and scored for every moment that has matches, at every step of the day."""

import pytest

from marketloom.operators import library as L
from marketloom.plans import library as plans


@pytest.fixture(scope="module")
def wanted(spark, sf):
    lib, _ = plans.library(spark, sf)
    found = L.search(lib, lib, plans.CHOSEN, plans.DIAL, plans.WINDOW, plans.APART)
    return {tuple(r) for r in found.select("q_symbol", "q_date", "q_step").distinct().collect()}


@pytest.mark.parametrize("name", ["o174_o175_pocket_maps", "o177_pocket_blobs", "o178_o181_pocket_scores"])
def test_all_moments_are_asked(spark, sf, wanted, name):
    rows = getattr(plans, name)(spark, sf).select("q_symbol", "q_date", "q_step").distinct().collect()
    assert len({r.q_step for r in rows}) == plans.LAST - plans.FIRST + 1
    assert len(rows) <= len(wanted) and {tuple(r) for r in rows} <= wanted and len(rows) > 0.9 * len(wanted)
