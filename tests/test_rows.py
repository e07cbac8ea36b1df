"""Assembled rows, coverage ids, augmentation, payloads, releases and merged builds: refusals, edge cases, brute force."""

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cinderspan.functions import grid
from cinderspan.operators import assembly, frontier, payloads

AT = datetime(2024, 1, 2, 3, 4, 5)


def test_training_rows_refuse_missing_evidence_and_repeats(spark):
    labels = spark.createDataFrame([(1, 2, AT), (3, 4, AT)], "x int, y int, anchor_at timestamp")
    state = labels.withColumn("local_count", F.lit(0))
    land = spark.createDataFrame([(1, 2, 5.0)], "x int, y int, slope_deg double")
    rows = {r.x: r for r in assembly.training_rows(labels, state, land, "b").collect()}
    assert rows[1].terrain_status == "available" and rows[3].terrain_status == "outside-source" and rows[3].slope_deg is None
    want = hashlib.sha256("\x1f".join(["1", "naea-1km:x=1:y=2", "2024-01-02T03:04:05Z", "43200"]).encode()).hexdigest()
    assert rows[1].example_id == want and rows[1].target_end_at == datetime(2024, 1, 2, 15, 4, 5) and rows[1].weather_missing_indicator == 1
    with pytest.raises(Exception, match="the label has evidence"):
        assembly.training_rows(labels, state.where("x = 1"), land, "b").count()
    with pytest.raises(Exception, match="one label for each cell and cutoff"):
        assembly.training_rows(labels.unionByName(labels), state, land, "b").count()
    assert assembly.training_rows(labels.limit(0), state, land, "b").count() == 0


def test_coverage_ids_need_all_parts(spark):
    df = spark.createDataFrame([("CONUS",), (None,)], "region string")
    assert [r[0] for r in df.select(assembly.coverage_id("firms", F.col("region"), "2024-01-01")).collect()] == ["firms:CONUS:2024-01-01", None]


def test_cell_lineage_leaves_blank_ids_out(spark):
    d = spark.createDataFrame([(0, 0, AT, " d1 ", "r"), (0, 0, AT, "", None), (1, 0, None, "d0", "r")], "x int, y int, acquired_at timestamp, detection_id string, raw_artifact_id string")
    got = {(r.x, r.y): r for r in assembly.cell_lineage(d).collect()}
    assert got[0, 0].source_detection_ids == ["d0", "d1"] and got[0, 0].source_detection_count == 3 and got[0, 0].source_raw_artifact_ids == ["r"] and got[0, 0].latest_acquired_at == AT
    assert got[2, 1].source_detection_ids == ["d0"] and got[2, 1].latest_acquired_at is None and len(got) == 12


def test_one_step_augmentation_by_hand(spark):
    """One active cell ignites one neighbour for sure; the next snapshot has examples on and off the new frontier."""
    t = lambda h: datetime(2024, 1, 1, h)
    active = spark.createDataFrame([(t(0), 0, 0, 0.8, 0)], "scenario timestamp, x int, y int, intensity double, age_steps int")
    burned = spark.createDataFrame([(t(0), -1, 0)], "scenario timestamp, x int, y int")
    examples = spark.createDataFrame(
        [(t(12), 2, 0, "hit", 1, 0), (t(12), 0, 1, "old", 0, 0), (t(12), 1, 0, "lit", 1, 0), (t(12), 9, 9, "far", 1, 0), (t(12), 2, 1, "burning", 1, 1)],
        "scenario timestamp, x int, y int, example_id string, target int, flag int",
    )
    chance = F.when((F.col("x") == 1) & (F.col("y") == 0), 1.0).otherwise(0.0)
    rows, report = assembly.one_step_augmentation(active, burned, examples, chance)
    got = {r.example_id: r for r in rows.collect()}
    # The new cell (1, 0) of intensity 0.68 is active with the old one, so (2, 0) sees one cell and (0, 1) two; (1, 0) itself is no frontier.
    assert set(got) == {"hit", "old"} and got["hit"].local_active_cells == 1 and got["old"].local_active_cells == 2
    assert got["hit"].local_max == pytest.approx(305 + 62 * 0.68) and got["hit"].local_hours_since == 3 and got["old"].local_max == pytest.approx(305 + 62 * 0.8)
    r = report.first()
    assert (r.matched, r.matched_positives, r.unreached, r.unreached_positives) == (2, 1, 2, 2) and r.outside == len({(x, y) for a in (0, 1) for x in (a - 1, a, a + 1) for y in (-1, 0, 1)} - {(0, 0), (1, 0), (-1, 0)}) - 2
    assert assembly.one_step_augmentation(active, burned, examples.withColumn("scenario", F.lit(t(6))), chance)[1].count() == 0
    with pytest.raises(Exception, match="probability is valid"):
        assembly.one_step_augmentation(active, burned, examples, F.lit(1.5))[0].count()
    with pytest.raises(Exception, match="one frontier row"):
        assembly.one_step_augmentation(active, burned, examples.unionByName(examples), chance)[0].count()


def test_allowed_cells(spark):
    active = spark.createDataFrame([(1, 0, 0, 0.5)], "scenario int, x int, y int, intensity double")
    assert frontier.frontier_candidates(active, active.limit(0), allowed=F.col("x") > 0).count() == 3


def test_file_facts_of_any_size(spark, tmp_path, monkeypatch):
    folder = tmp_path / "release"
    (folder / "in").mkdir(parents=True)
    data = {"a.nc": b"CDF\x01" + b"x" * 100, "in/b.nc": b"abc", "in/c.nc": b"\x89HDF\r\n\x1a\n" + bytes(range(256)) * 40_000}
    for name, content in data.items():
        (folder / name).write_bytes(content)
    got = {r.name: r for r in payloads.file_facts(spark, str(folder)).collect()}
    assert {k: (r.n_bytes, r.digest) for k, r in got.items()} == {k: (len(v), hashlib.sha256(v).hexdigest()) for k, v in data.items()}
    assert got["a.nc"].head == "4344460178787878" and got["in/b.nc"].head == "616263"
    stated = spark.createDataFrame([("a.nc", 200, "104", None, "SHA-256", hashlib.sha256(data["a.nc"]).hexdigest().upper()), ("in/b.nc", 200, None, None, None, None), ("in/c.nc", 500, None, None, None, None)], "name string, status_code int, content_length string, content_encoding string, checksum_algorithm string, checksum string")
    faults = {r.name: r.fault for r in payloads.file_facts(spark, str(folder)).join(stated, "name").select("name", payloads.payload_fault().alias("fault")).collect()}
    assert faults == {"a.nc": None, "in/b.nc": "signature", "in/c.nc": "HTTP 500"}


def test_names_and_manifests_of_releases(spark):
    names = ["ok/a.csv", "/etc/x", "s3://b/c", "a/../b", "a\\b", "a//b", "", "twice", "twice", None]
    got = {r.name: r.fault for r in payloads.name_faults(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    assert got == {"/etc/x": "absolute", "s3://b/c": "absolute", "a/../b": "leads-out", "a\\b": "backslash", "a//b": "empty-part", "": "blank", None: "blank", "twice": "repeated"}
    schema = "build_id string, kind string, schema_version int, start_on string, end_on string, weather_available boolean, features array<string>, n_rows long"
    good = ("good", "candidate-release", 2, "2024-01-01", "2024-01-31", False, ["count", "slope"], 10)
    bad = ("bad", "other", 1, "2024-02-01", "2024-01-31", True, ["cell_id", "none", "none"], 9)
    got = payloads.release_faults(spark.createDataFrame([good, bad], schema), ["count", "slope", "cell_id"], 10).collect()
    assert {r.build_id for r in got} == {"bad"} and len(got) == 8


def test_release_scan_is_pruned_and_counted(spark, tmp_path):
    path = str(tmp_path / "r")
    spark.range(10).selectExpr("id as a", "id * 2 as b", "id * 3 as c").write.csv(path, header=True)
    found = assembly.read_release(spark, path, ["c", "a"], 10)
    assert found.columns == ["c", "a"] and "ReadSchema: struct<a:string,c:string>" in found._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="holds 10 rows"):
        assembly.read_release(spark, path, ["a"], 11)
    with pytest.raises(ValueError, match="no columns"):
        assembly.read_release(spark, path, ["z"], 10)


def test_builds_merge_only_when_contiguous(spark, tmp_path):
    for k in range(2):
        spark.range(k * 5, k * 5 + 5).write.parquet(str(tmp_path / f"b{k}"))
    spark.range(3).write.parquet(str(tmp_path / "same"))

    def merged(*rows, first="2024-01-01", last="2024-01-04"):
        builds = spark.createDataFrame([(b, p, datetime.fromisoformat(s).date(), datetime.fromisoformat(e).date(), str(tmp_path / f), n) for b, p, s, e, f, n in rows], "build_id string, policy string, start_on date, end_on date, path string, n_rows long")
        return assembly.merged_builds(spark, builds, ["id"], first, last)

    one, two = ("x", "p", "2024-01-01", "2024-01-02", "b0", 5), ("y", "p", "2024-01-03", "2024-01-04", "b1", 5)
    rows, manifest = merged(one, two)
    assert rows.count() == 10 and manifest.first().n_rows == 10 and manifest.first().merged_from == ["x", "y"]
    for bad, message in (
        ((one, ("y", "q", *two[2:])), "policy"),
        ((one, ("y", "p", "2024-01-04", "2024-01-04", "b1", 5)), "gap"),
        ((one, ("y", "p", "2024-01-02", "2024-01-04", "b1", 5)), "overlap"),
        ((one, ("y", "p", "2024-01-03", "2024-01-05", "b1", 5)), "span"),
        ((one, ("y", "p", "2024-01-03", "2024-01-04", "b1", 6)), "holds 5 rows"),
        ((one, ("y", "p", "2024-01-03", "2024-01-04", "same", 3)), "in common"),
    ):
        with pytest.raises(Exception, match=message):
            merged(*bad)[0].count()


def test_scores_that_end_in_a_half_round_as_in_sql(spark):
    """Sums of many detections often end in an exact half at the sixth place."""
    import duckdb

    score = lambda rounding: grid.evidence_score("b", "n", "(s / 3600e0)", rounding=rounding)
    rows = "(select 3e2 + v * 67e-2 as b, cast(n as double) as n, k * 27 as s from range(0, 3201) q(k), (values (1e2), (4e-1), (12e-1)) w(v), (values (10), (42)) m(n)) t"
    want = duckdb.sql(f"select b, n, s, {score('round_even')} from {rows}").fetchall()
    held = spark.createDataFrame([r[:3] for r in want], "b double, n double, s long")
    for rounding, all_same in (("", True), ("bround", False)):
        found = {(r.b, r.n, r.s): r.score for r in held.selectExpr("*", f"{score(rounding)} as score").collect()}
        assert all(found[r[:3]] == r[3] for r in want) == all_same
