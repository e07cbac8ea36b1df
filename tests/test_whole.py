"""Queries that look at every cutoff and every selected candidate."""

import pytest

from cinderspan.plans import catalog
from cinderspan.sources import adapters

SF = "/root/testdata/sf0.001"


def test_every_forecast_span_meets_an_anchor(spark):
    found = catalog.queries()["forecasts_known_half_daily"](spark, SF)
    assert found.where("anchor_at >= timestamp '2000-01-01'").select("anchor_at").distinct().count() > 2 * catalog.queries()["forecasts_known"](spark, SF).select("anchor_at").distinct().count()


def test_current_cells_see_every_detection(spark):
    found = catalog.queries()["current_cells_half_daily"](spark, SF)
    cells = adapters.located(spark, SF).where("acquired_at is not null").select("x", "y").distinct()
    assert cells.join(found, ["x", "y"], "left_anti").count() == 0


@pytest.mark.parametrize("name, keys", [("fire_state_features_selected", ["x", "y", "anchor_at"]), ("seed_lineage_selected", ["snapshot", "x", "y"])])
def test_selected_candidates_have_features_and_lineage(spark, name, keys):
    selected = catalog.queries()["candidates_selected"](spark, SF)
    assert selected.where("target = 0").count() > 0
    assert selected.join(catalog.queries()[name](spark, SF), keys, "left_anti").count() == 0
