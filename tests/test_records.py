"""Known values, refusals, and the greedy cover against a plain sweep."""

import math

import pytest
from pyspark.sql import functions as F

from cinderspan.functions import grid
from cinderspan.operators import records, spatial
from cinderspan.plans import catalog
from cinderspan.session import cut, remove_written

SF = "/root/testdata/sf0.001"


def test_grid_known_values(spark):
    df = spark.createDataFrame([(53.5461, -113.4938)], "lat double, lon double")
    x, y = grid.albers("lat", "lon")
    found = df.selectExpr(f"{x} as x", f"{y} as y").first()
    assert abs(found.x + 1105646.359) < 0.01 and abs(found.y - 1696547.854) < 0.01
    # 0.55 * 0.5 + 0.2 * 0.5 of 24 h, and a half in the seventh place that goes to the even side
    assert spark.range(1).selectExpr(grid.evidence_score("200D", "0D", "12D")).first()[0] == 0.375


def test_times_of_one_to_four_digits(spark):
    rows = [("40", "00:40"), ("5", "00:05"), ("1230", "12:30"), (" 930 ", "09:30"), ("2460", None), ("12345", None), ("x", None), ("", None), (None, None)]
    df = spark.createDataFrame([(t,) for t, _ in rows], "t string").withColumn("d", F.lit("2024-02-29"))
    found = df.select(F.date_format(records.hhmm("d", "t"), "HH:mm")).collect()
    assert [r[0] for r in found] == [w for _, w in rows]


def test_checks_refuse(spark):
    raw = spark.createDataFrame([("91.0", "0.0", "300", "2024-01-01", "1")], "latitude string, longitude string, bright_ti4 string, acq_date string, acq_time string")
    with pytest.raises(Exception, match="rule latitude"):
        records.normalize_detections(raw, "NASA", F.lit("VIIRS")).collect()
    twice = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None)], "id int, v string")
    assert {tuple(r) for r in records.once_by_id(twice, "id").collect()} == {(1, "a"), (2, None)}
    with pytest.raises(Exception, match="rows of one id differ"):
        records.once_by_id(twice.unionByName(spark.createDataFrame([(1, "b")], "id int, v string")), "id").collect()
    with pytest.raises(Exception, match="one to one"):
        records.merge_one_to_one(twice, twice.select("id").distinct(), "id").collect()
    assert records.once_by_id(twice.limit(0), "id").count() == 0


def test_cell_ids(spark):
    df = spark.createDataFrame([("naea-1km:x=-3:y=7",), ("webmercator:x=1:y=2",), (None,)], "c string")
    assert [r.c and tuple(r.c) for r in df.select(records.cell_of_id("c").alias("c")).collect()] == [(-3, 7), None, None]


def test_cover_is_the_greedy_one(spark):
    places = {(r.longitude, r.latitude) for r in catalog.queries()["nearest_sources"](spark, SF).collect()}
    for radius in (20_000.0, 60_000.0):
        def ecef(p):
            f, l, e2 = math.radians(p[1]), math.radians(p[0]), 1 - (1 - 1 / 298.257222101) ** 2  # noqa: E741
            nu = 6378137 / math.sqrt(1 - e2 * math.sin(f) ** 2)
            return nu * math.cos(f) * math.cos(l), nu * math.cos(f) * math.sin(l), nu * (1 - e2) * math.sin(f)

        taken = []
        for p in sorted(places):
            if all(math.dist(ecef(p), ecef(q)) > radius for q in taken):
                taken.append(p)
        df = spark.createDataFrame(sorted(places, reverse=True), "longitude double, latitude double")
        assert {tuple(r) for r in spatial.covering_sources(df, radius).collect()} == set(taken)


def test_written_tables_are_removed(spark):
    held = cut(spark.range(5), "removed")
    assert held.count() == 5 and remove_written(spark) > 0
    with pytest.raises(Exception):
        held.count()
