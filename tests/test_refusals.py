"""Refusals hold whatever is read; pruned scans; joins that know time."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cinderspan.operators import evaluate, fire, frontier, records, views
from cinderspan.sources import features


def fails(df, message):
    for read in (lambda: df.count(), *(lambda c=c: df.select(c).collect() for c in df.columns)):
        with pytest.raises(Exception, match=message):
            read()


def test_require_fails_for_counts_and_any_column(spark):
    df = spark.createDataFrame([(1, 0.5), (2, -1.0)], "id int, w double")
    fails(records.require(df, {"weight": F.col("w") > 0}), "row breaks the rule weight")
    fails(records.require(df, {"null": F.when(F.col("id") == 1, True)}), "row breaks the rule null")
    assert records.require(df, {"id": F.col("id") > 0}).count() == 2
    fails(records.require_once(df.unionByName(df), ["id"], "once"), "row breaks the rule once")
    assert records.require_once(df, ["id"], "once").collect() == df.collect()


def test_normalized_detections_fail_for_any_column(spark):
    raw = spark.createDataFrame([("2024-01-01", "0130", "91", "10", "310")], "acq_date string, acq_time string, latitude string, longitude string, bright_ti4 string")
    fails(records.normalize_detections(raw, "firms", F.lit("P")), "row breaks the rule latitude")


def test_once_by_id_and_merge_and_mix_fail_for_any_column(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    fails(records.once_by_id(df, "id"), "rows of one id differ: 1")
    assert sorted(map(tuple, records.once_by_id(df.where("v <> 'b'").unionByName(df.where("v = 'a'")), "id").collect())) == [(1, "a"), (2, "c")]
    fails(records.merge_one_to_one(df.where("v <> 'b'"), spark.createDataFrame([(1, 5)], "id int, w int"), "id"), "one to one")
    mixed = spark.createDataFrame([("a", 1.0), ("b", 0.0)], "example_id string, sample_weight double")
    fails(views.checked_mix(mixed, "sample_weight", "example_id"), "weight")


def test_one_class_holdout_fails_for_any_column(spark):
    df = spark.createDataFrame([(datetime(2024, 1, d), 1) for d in range(1, 5)], "t timestamp, y int")
    fails(evaluate.holdout_masks(df, "t", 0.5), "a side is empty or of one class")


@pytest.mark.parametrize(
    "read, page, message",
    [
        (features.read_perimeter_pages, {"error": {"code": 400, "message": "x"}}, "no feature page"),
        (features.read_perimeter_pages, {"features": [{"attributes": {"fireid": 1}, "geometry": {"rings": []}}]}, "no polygon"),
        (features.read_geojson, {"type": "Feature", "features": []}, "no feature collection"),
        (features.read_geojson, {"type": "FeatureCollection", "features": [{"properties": {"id": "1"}}]}, "no properties or geometry"),
        (lambda s, p: features.incident_history(features.read_geojson(s, p)), {"type": "FeatureCollection", "features": [{"properties": {"id": ""}, "geometry": {"type": "Point"}}]}, "no incident id"),
        (lambda s, p: features.read_granules(s, p, "P", "1"), {"total": 3}, "no inventory"),
        (lambda s, p: features.read_granules(s, p, "P", "1"), {"items": [{"umm": {"GranuleUR": "g", "CollectionReference": {"ShortName": "Q", "Version": "1"}}}]}, "other product"),
    ],
)
def test_pages_fail_for_any_column(spark, tmp_path, read, page, message):
    (tmp_path / "page.json").write_text(json.dumps(page))
    fails(read(spark, str(tmp_path)), message)


def test_window_of_labels_prunes_folders(spark, tmp_path):
    days = [(i, datetime(2024, 1, 1) + timedelta(days=i)) for i in range(30)]
    d = spark.createDataFrame(days, "id int, t timestamp").withColumn("acq_date", F.to_date("t"))
    d.write.partitionBy("acq_date").parquet(str(tmp_path / "d"))
    held = spark.read.parquet(str(tmp_path / "d"))
    labels = spark.createDataFrame([(datetime(2024, 1, 11, 2),), (datetime(2024, 1, 12, 2),)], "anchor_at timestamp")
    found = records.in_window_of(held, labels)
    assert sorted(r.id for r in found.collect()) == [9, 10]  # 10 January 02:00 to 11 January 23:00
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "acq_date" in filters and ">=" in filters and "<=" in filters and "Join" not in plan
    assert len(found.inputFiles()) == 30 and "BroadcastNestedLoopJoin" not in plan
    assert records.in_window_of(held, labels.limit(0)).count() == 0


def brute_state(cells, detections):
    out = {}
    for x, y, at in cells:
        seen = [d for d in detections if abs(d[1] - x) <= 1 and abs(d[2] - y) <= 1 and at - timedelta(hours=24) <= d[3] <= at - timedelta(hours=3)]
        out[x, y, at] = (len(seen), len([d for d in seen if (d[1], d[2]) == (x, y)]), max((d[4] for d in seen), default=None))
    return out


def test_ten_years_of_a_cell_meet_only_their_own_days(spark):
    rng, start = random.Random(1), datetime(2014, 1, 1)
    detections = [(f"d{k}", rng.randint(-1, 2), 0, start + timedelta(hours=12 * k, minutes=rng.choice([0, 0, 60, 540, rng.randint(0, 719)])), 300.0 + k % 60, "P") for k in range(7300)]
    cells = [(0, 0, start + timedelta(hours=12 * k)) for k in range(7300)]
    d = spark.createDataFrame(detections, "detection_id string, x int, y int, acquired_at timestamp, bright_ti4 double, product string")
    c = spark.createDataFrame(cells, "x int, y int, anchor_at timestamp")
    state = fire.fire_state(c, d)
    plan = state._jdf.queryExecution().optimizedPlan().toString()
    assert "stretch" in plan
    got = {(r.x, r.y, r.anchor_at): (r.local_count, r.center_count, r.local_max) for r in state.collect()}
    by_day = {}
    for row in detections:
        by_day.setdefault((row[3] - start).days, []).append(row)
    for k in range(0, 7300, 37):
        day = (cells[k][2] - start).days
        near = [row for n in range(day - 2, day + 1) for row in by_day.get(n, [])]
        assert got[cells[k]] == brute_state([cells[k]], near)[cells[k]]
    # The pairs that meet before the gate: a cell's stretch has two days of its nine neighbours.
    met = c.select("x", "y", fire.stretch("anchor_at", 24).alias("s")).join(frontier.neighbours(d.withColumn("s", F.explode(fire.stretches("acquired_at", 24, 3))).select("x", "y", "s"), 1), ["x", "y", "s"]).count()
    assert met <= 10 * len(cells)
    lineage = frontier.seed_lineage(c.withColumn("snapshot", F.col("anchor_at")), d, 2).collect()
    assert sum(r.n_seeds for r in lineage) == sum(len([1 for row in [r for n in range((at - start).days - 2, (at - start).days + 1) for r in by_day.get(n, [])] if at - timedelta(hours=24) <= row[3] <= at - timedelta(hours=3)]) for _, _, at in cells)
