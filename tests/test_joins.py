"""Sides that explode makes larger are shuffled, whatever Spark believes of their size: a broadcast of them would pass through the driver."""

import pytest

from cinderspan.plans import catalog

SF = "/root/testdata/sf0.001"


def exploded_broadcasts(df):
    """The broadcasts of a plan, at Spark's own threshold, that have an explode below them."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-*(0123456789)")) for line in lines]
    found = []
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = [line for j, line in enumerate(lines[i + 1 :], i + 1) if all(d > depth[i] for d in depth[i + 1 : j + 1])]
            found += [line] if any("Generate explode" in b for b in below) else []
    return found


@pytest.mark.parametrize("name", ["candidates_near_perimeters", "newly_covered_cells", "label_merge", "label_windows", "seed_lineage", "seed_lineage_selected"])
def test_no_query_broadcasts_what_it_explodes(spark, name):
    assert exploded_broadcasts(catalog.queries()[name](spark, SF)) == []


def test_pairs_of_snapshots_are_not_broadcast(spark):
    """Records are wider than their file, so its size says nothing of a broadcast's."""
    plan = catalog.queries()["perimeter_pairs"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_pairs_of_points_and_perimeters_are_not_shuffled(spark):
    """They may be many times the points: below what writes them stands the join, and no exchange before it."""
    plan = catalog.queries()["perimeter_distances"](spark, SF)._jdf.queryExecution().executedPlan().toString().splitlines()
    first = {name: next(k for k, line in enumerate(plan) if name in line) for name in ("SortMergeJoin", "Exchange")}
    assert first["SortMergeJoin"] < first["Exchange"] and not any("Aggregate" in line for line in plan)
