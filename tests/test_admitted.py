"""Origins of splits, captures, mixed views, terrain of frontiers, boxes and ordered files by hand."""

import glob

import pytest
from pyspark.sql import functions as F

from cinderspan.functions import grid
from cinderspan.operators import fire, frontier, incidents, views
from cinderspan.session import shared_path


def half_days(spark, rows):
    """(key, number of the half-day, split) rows as times."""
    return spark.createDataFrame(rows, "k string, n long, s string").select("k", F.timestamp_seconds(F.col("n") * 43200).alias("t"), "s")


def origins(spark, rows, seeds, length=3):
    found = incidents.first_origins(half_days(spark, rows), ["k"], "t", "s", half_days(spark, [(k, n, None) for k, n in seeds]), length)
    return {(r["k"], r["s"]): (r["o"], r["n_times"]) for r in found.select("k", "s", (F.unix_seconds("origin") / 43200).cast("int").alias("o"), "n_times").collect()}


def test_origin_needs_a_run_a_seed_and_one_split(spark):
    rows = [("a", n, "train") for n in range(6)] + [("a", 2, "validation"), ("a", 7, "validation"), ("a", 8, "validation"), ("a", 9, "validation"), ("a", 4, None)]
    # Half-day 2 is of both splits, so the first run is too short; 3 to 5 is the first that is whole.
    assert origins(spark, rows, [("a", 0), ("a", 1), ("a", 3), ("a", 7)]) == {("a", "train"): (3, 3), ("a", "validation"): (7, 3)}
    assert origins(spark, rows, [("a", 4), ("a", 7)]) == {("a", "validation"): (7, 3)}  # what 4 begins is too short
    assert origins(spark, rows, []) == {} and origins(spark, [], []) == {}


def test_origin_may_lie_within_a_run_and_gaps_end_it(spark):
    rows = [("a", n, "train") for n in (0, 1, 2, 3, 4, 6, 7, 8)] * 2
    assert origins(spark, rows, [("a", 2), ("a", 6)]) == {("a", "train"): (2, 3)}
    assert origins(spark, rows, [("a", 3), ("a", 6)]) == {("a", "train"): (6, 3)}


def captures(spark, rows):
    return spark.createDataFrame(rows, "c string, a string, b string").select(*(F.col(x).cast("timestamp").alias(y) for x, y in (("c", "captured_at"), ("a", "start_at"), ("b", "end_at"))))


CAPTURED = [("2024-01-01", "2023-05-01", "2023-05-03"), ("2024-01-01", "2023-05-01", "2023-05-03"), ("2024-01-01", "2023-05-04", "2023-05-05"), ("2024-02-01", "2023-05-04", "2023-05-05"), ("2024-03-01", "2023-09-01", "2023-09-02")]


def chosen(df):
    return [(str(r["captured_at"])[:10], r["n_windows"]) for r in df.collect()]


def test_capture_by_coverage_ties_and_open_sides(spark):
    c = captures(spark, CAPTURED)
    assert chosen(views.select_capture(c, "2023-05-01", "2023-05-31")) == [("2024-01-01", 2)]
    assert chosen(views.select_capture(c, "2023-05-04", "2023-05-31")) == [("2024-02-01", 1)]  # a tie: the newest
    assert chosen(views.select_capture(c, "2030-01-01")) == [("2024-03-01", 0)]
    assert chosen(views.select_capture(c)) == [("2024-01-01", 2)]
    assert chosen(views.select_capture(c.limit(0))) == []


def test_named_capture_or_what_there_is(spark):
    c = captures(spark, CAPTURED)
    assert chosen(views.select_capture(c, captured_at="2024-02-01")) == [("2024-02-01", 1)]
    with pytest.raises(ValueError, match="2024-01-01 00:00:00, 2024-02-01 00:00:00, 2024-03-01 00:00:00"):
        views.select_capture(c, captured_at="2024-02-02")


def test_capture_windows_must_last(spark):
    bad = captures(spark, [*CAPTURED, ("2024-03-01", "2023-05-03", "2023-05-03")])
    with pytest.raises(Exception, match="window ends after its start"):
        views.select_capture(bad, "2023-05-01").count()


def test_artifacts_of_a_capture_are_distinct_by_content(spark):
    rows = [("2024-01-01", "x", "m2"), ("2024-01-01", "x", "m1"), ("2024-01-01", "y", "m3"), ("2024-02-01", "x", "m0")]
    m = spark.createDataFrame(rows, "captured_at string, content_sha256 string, manifest_path string").withColumn("captured_at", F.col("captured_at").cast("timestamp"))
    found = views.capture_artifacts(m, views.select_capture(captures(spark, CAPTURED), captured_at="2024-01-01"))
    assert sorted((r["content_sha256"], r["manifest_path"]) for r in found.collect()) == [("x", "m1"), ("y", "m3")]


EXAMPLE = "example_id string, incident_group_id string, incident_split string, firms_center_has_detection int, heat double"
EXAMPLES = [("e1", "g", "train", 0, 1.0), ("e2", "g", "train", 0, 2.0), ("e3", "g", "train", 1, 3.0), ("e4", "g", "later_time", 0, 4.0)]
REFERENCE = "example_id string, incident_group_id string, sample_weight double"
SYNTHETIC = "example_id string, incident_group_id string, sample_weight double, parent string"


def mixed(spark, references, synthetic, how):
    return how(spark.createDataFrame(references, REFERENCE), spark.createDataFrame(synthetic, SYNTHETIC), spark.createDataFrame(EXAMPLES, EXAMPLE), 0.25, 0.5)


def test_mixed_view_unites_what_is_sound(spark):
    found = mixed(spark, [("e1", "g", 1.0), ("e2", "g", 1.0)], [("s1", "g", 0.25, "e1")], views.mixed_view)
    assert sorted((r["example_id"], r["heat"], r["sample_weight"], r["parent"]) for r in found.collect()) == [("e1", 1.0, 1.0, None), ("e2", 2.0, 1.0, None), ("s1", None, 0.25, "e1")]
    assert mixed(spark, [], [], views.mixed_view).count() == 0


@pytest.mark.parametrize(
    "references, synthetic, faults",
    [
        ([("e1", "g", 1.0), ("e1", "g", 1.0)], [], {"repeated": 1}),
        ([("e1", "g", 0.5), ("e2", "g", None)], [], {"observed-weight": 2}),
        ([("e9", "g", 1.0)], [], {"unknown": 1}),
        ([("e3", "g", 1.0), ("e4", "g", 1.0)], [], {"centre": 1, "split": 1}),
        ([("e1", "h", 1.0), ("e2", None, 1.0)], [], {"group": 2}),
        ([("e1", "g", 1.0), ("e2", "g", 1.0)], [("s1", "g", 0.5, "e1")], {"synthetic-weight": 1}),
        ([("e1", "g", 1.0)], [("s1", "g", 0.25, "e1")], {"too-many": 1}),
    ],
)
def test_mixed_view_names_each_fault(spark, references, synthetic, faults):
    assert {r["fault"]: r["n"] for r in mixed(spark, references, synthetic, views.mix_faults).collect()} == faults
    with pytest.raises(ValueError, match=next(iter(faults))):
        mixed(spark, references, synthetic, views.mixed_view)


TERRAIN = "x int, y int, terrain_valid boolean, terrain_elevation_m double, terrain_slope_degrees double, terrain_aspect_defined boolean, terrain_aspect_sin double, terrain_aspect_cos double"


def test_terrain_of_invalid_and_unknown_cells_is_null(spark):
    ground = [(0, 0, True, 5.0, 1.0, True, 0.5, 0.5), (1, 0, True, 6.0, 2.0, None, 0.0, 0.0), (2, 0, False, 7.0, float("nan"), True, None, 0.1)]
    rows = spark.createDataFrame([(k, 0, "s") for k in range(4)], "x int, y int, scenario string")
    found = {r["x"]: r for r in frontier.with_terrain(rows, spark.createDataFrame(ground, TERRAIN)).collect()}
    assert [(found[k]["terrain_valid"], found[k]["terrain_aspect_defined"], found[k]["terrain_elevation_m"]) for k in range(4)] == [(1, 1, 5), (1, 0, 6), (0, 0, None), (0, 0, None)]
    assert found[2]["terrain_aspect_cos"] is None and found[3]["scenario"] == "s"


@pytest.mark.parametrize("value", [None, float("nan"), float("inf")])
def test_valid_terrain_must_be_finite(spark, value):
    rows = spark.createDataFrame([(0, 0)], "x int, y int")
    with pytest.raises(Exception, match="finite terrain"):
        frontier.with_terrain(rows, spark.createDataFrame([(0, 0, True, 1.0, value, True, 0.0, 0.0)], TERRAIN)).count()


def test_box_reports_count_ages_and_repeats(spark):
    rows = [("p", 45.0, -100.0, h, 7, 7) for h in (12, 12, 21, 22)] + [("p", 39.9, -100.0, 12, 7, 8), ("p", 40.0, -115.0, 1, 8, 8)]
    d = spark.createDataFrame(rows, "product string, latitude double, longitude double, h int, x int, y int").withColumn("acquired_at", F.timestamp_seconds(F.col("h") * 3600))
    found = {r["n"]: r[1:] for r in fire.snapshot_reports(d, (-115.0, 40.0, -85.0, 55.0)).withColumn("n", F.unix_seconds("snapshot") / 43200).select("n", "eligible_detection_count", "recent_detections_excluded", "active_cell_count").collect()}
    assert found == {1: (1, 1, 1), 2: (3, 1, 2), 3: (3, 0, 1)}


def test_repeats_of_a_cell_dont_change_candidates(spark):
    """One detection a cell, or many that all of its neighbours see: the same candidates; those at an end of the gate count by themselves."""
    base = [(100, 200, 40 * 3600)]
    more = [(100, 200, 36 * 3600 + 60 * k) for k in range(600)]
    frame = lambda rows: spark.createDataFrame(rows, "x int, y int, s long").withColumn("acquired_at", F.timestamp_seconds("s"))
    one = {tuple(r) for r in fire.expand_candidates(frame(base)).collect()}
    got = {tuple(r) for r in fire.expand_candidates(frame(more)).collect()}
    gated = frame(more).crossJoin(fire.expand_candidates(frame(more)).select("snapshot", F.col("x").alias("cx"), F.col("y").alias("cy"), "anchor_at"))
    seen = gated.where("acquired_at between anchor_at - interval 24 hours and anchor_at - interval 3 hours").select("snapshot", "cx", "cy", "anchor_at").distinct()
    assert {tuple(r) for r in seen.collect()} == got and one <= got and len(one) % 25 == 0 and one


def test_cell_bounds(spark):
    assert [float(v) for v in spark.range(1).selectExpr(*grid.cell_bounds("-3", "7")).first()] == [-3000, 7000, -2000, 8000]


def test_ordered_files(spark):
    path = shared_path(spark, "ordered")
    views.write_ordered(spark.range(1000).select(F.xxhash64("id").alias("k"), "id"), path, "k", files=4)
    files = sorted(glob.glob(path.replace("file://", "") + "/part-*"))
    keys = [r["k"] for f in files for r in spark.read.parquet(f).collect()]
    assert len(files) == 4 and len(keys) == 1000 and keys == sorted(keys)
