"""Components, the grid's closed forms, and features of the first detections."""

import math
import random

from pyspark.sql import functions as F

from cinderspan.functions import grid
from cinderspan.operators import fire, ledger
from cinderspan.operators.components import connected_components


def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5), (None, 7)]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None:
            a, b = sorted((find(a), find(b)))
            up[b] = a
    found = connected_components(spark.createDataFrame(edges, "src long, dst long"))
    assert {r.node: r.component for r in found.collect()} == {x: find(x) for x in up}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_grid_round_trip(spark):
    df = spark.createDataFrame([(48.3, -101.2), (30.0, -85.5), (61.5, -140.0)], "lat double, lon double")
    x, y = grid.cell_xy("lat", "lon")
    back = df.selectExpr("*", f"{x} as x", f"{y} as y").selectExpr("*", f"{grid.centre_lon('x', 'y')} as lon2", f"{grid.centre_lat('x', 'y')} as lat2")
    for r in back.collect():
        assert abs(r.lat - r.lat2) < 0.01 and abs(r.lon - r.lon2) < 0.02
    x, y, z = (df.selectExpr(e).first()[0] for e in grid.ecef("0D", "0D"))
    assert (round(x), round(y), round(z)) == (6378137, 0, 0)
    assert abs(df.selectExpr(grid.logit("5e-1")).first()[0]) < 1e-12 and math.isfinite(df.selectExpr(grid.logit("0D")).first()[0])


def test_neighbourhood_gate(spark):
    det = spark.createDataFrame(
        [("a", 0, 0, "2024-01-01 10:00:00", 320.0), ("a", 0, 0, "2024-01-01 10:00:00", 320.0), ("b", 1, 1, "2024-01-01 11:00:00", 330.0), ("late", 0, 0, "2024-01-01 12:00:00", 360.0), ("old", 0, 0, "2023-12-31 13:59:00", 360.0)],
        "detection_id string, x int, y int, acquired_at string, bright_ti4 double",
    ).withColumns({"acquired_at": F.col("acquired_at").cast("timestamp"), "product": F.lit("p")})
    cells = spark.createDataFrame([(0, 0), (9, 9)], "x int, y int").withColumn("anchor_at", F.lit("2024-01-01 14:00:00").cast("timestamp"))
    rows = {r.x: r for r in fire.fire_state(cells, det).collect()}
    assert (rows[0].center_count, rows[0].center_max, rows[0].local_count, rows[0].local_hours_since) == (1, 320.0, 2, 3.0)
    assert (rows[9].local_count, rows[9].local_max) == (0, None)


def test_windows_and_sequences(spark):
    w = spark.range(1).select(ledger.expected_windows(F.lit("2024-01-01").cast("timestamp"), F.lit("2024-01-02 06:00:00").cast("timestamp"), 12).alias("w")).first().w
    assert len(w) == 3 and (w[2].end - w[2].start).seconds == 6 * 3600
    t = spark.createDataFrame([(1, h) for h in (0, 12, 36, 48, 84)], "g int, h int").selectExpr("g", "timestamp_seconds(h * 3600) as t")
    assert sorted(r["count"] for r in ledger.gap_sequences(t, ["g"], "t").groupBy("sequence").count().collect()) == [1, 2, 2]
