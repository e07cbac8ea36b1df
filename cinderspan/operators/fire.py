"""Detections to cells, cutoffs, candidates and leakage-safe features.

``cells`` are rows ``x, y, anchor_at`` (the cutoff); ``detections`` have ``x, y, acquired_at``.
A detection counts for a cutoff if it was acquired no earlier than the lookback before it and
was available, a lag after acquisition, no later than it: both ends belong.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderspan.functions import grid
from cinderspan.operators.records import once_by_id


def snapshots(detections: DataFrame, hours: int = 12) -> DataFrame:
    """Half-daily source times from the first to the last day, one row each."""
    ends = detections.agg(F.min(F.to_date("acquired_at")).alias("a"), F.max(F.to_date("acquired_at")).alias("b"))
    return ends.where("a is not null").select(F.explode(F.expr(f"sequence(cast(a as timestamp), cast(b as timestamp) + interval 12 hours, interval {hours} hours)")).alias("snapshot"))


def cutoff(snapshot: str = "snapshot", x: str = "x", y: str = "y") -> Column:
    """Physical cutoff of a cell: local-solar snapshot shifted by the cell centre's longitude."""
    return F.expr(f"timestamp_micros(unix_micros({snapshot}) + {grid.solar_offset_us(grid.centre_lon(x, y))})")


def _gate(acquired: Column, anchor: Column, lookback_h: int, lag_h: int) -> Column:
    return (acquired >= anchor - F.expr(f"interval {lookback_h} hours")) & (acquired <= anchor - F.expr(f"interval {lag_h} hours"))


def stretch(anchor: str, lookback_h: int) -> Column:
    """Number of the stretch of time, as long as the lookback, that a cutoff falls in."""
    return F.expr(f"cast(floor(unix_micros({anchor}) / {lookback_h * 3_600_000_000}) as bigint)")


def stretches(acquired: str, lookback_h: int, lag_h: int) -> Column:
    """Numbers of the stretches whose cutoffs may see a detection: two at most."""
    first, last = (stretch(f"({acquired} + interval {h} hours)", lookback_h) for h in (lag_h, lookback_h))
    return F.sequence(first, last)


def expand_candidates(detections: DataFrame, radius: int = 2, hours: int = 12, lookback_h: int = 24, lag_h: int = 3) -> DataFrame:
    """Cells within ``radius`` of an eligible detection, per snapshot: ``snapshot, x, y, anchor_at``.

    Each detection names the few snapshots that may see it, so no snapshot table is joined;
    eligibility is tested at the candidate's own cutoff. Of the detections that every cell around
    may see for sure one stands for all, so the neighbourhood is made once for each cell and
    snapshot, and again only for those within an hour of an end of the gate.
    """
    seeds = detections.select("x", "y", "acquired_at")
    # Cutoffs lie between 0 and 14 h after their snapshot on this continent.
    first = F.expr(f"date_trunc('day', acquired_at + interval {lag_h} hours - interval 24 hours)")
    times = F.sequence(first, F.expr(f"acquired_at + interval {lookback_h} hours"), F.expr(f"interval {hours} hours"))
    offsets = F.array(*(F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in range(-radius, radius + 1) for dy in range(-radius, radius + 1)))
    seen = seeds.select("x", "y", "acquired_at", F.explode(times).alias("snapshot"))
    # Cutoffs within the radius differ from the seed's own by minutes, so most snapshots are ruled out before the neighbourhood is made.
    seen = seen.where(_gate(F.col("acquired_at"), cutoff(), lookback_h + 1, lag_h - 1))
    edge = F.when(~_gate(F.col("acquired_at"), cutoff(), lookback_h - 1, lag_h + 1), F.col("acquired_at"))
    seen = seen.groupBy("x", "y", "snapshot", edge.alias("edge")).agg(F.max("acquired_at").alias("acquired_at"))
    grown = seen.select("snapshot", "acquired_at", "x", "y", F.explode(offsets).alias("o"))
    cells = grown.select("snapshot", "acquired_at", (F.col("x") + F.col("o.dx")).alias("x"), (F.col("y") + F.col("o.dy")).alias("y")).withColumn("anchor_at", cutoff())
    return cells.where(_gate(F.col("acquired_at"), F.col("anchor_at"), lookback_h, lag_h)).select("snapshot", "x", "y", "anchor_at").distinct()


def select_candidates(candidates: DataFrame, positives: DataFrame, cap: int = 2000) -> DataFrame:
    """Supported positives, and per snapshot the ``cap`` proxies with the lowest hash of snapshot and cell."""
    keys = ["snapshot", "x", "y"]
    known = positives.select(*keys).distinct().withColumn("target", F.lit(1))
    flagged = candidates.join(known.hint("merge"), keys, "left").fillna(0, ["target"])
    hashed = flagged.withColumn("rank", F.sha2(F.concat_ws("|", F.date_format("snapshot", "yyyy-MM-dd HH:mm:ss"), F.expr(grid.cell_id("x", "y"))), 256))
    # A snapshot's proxies are ranked in salts first, so only the best of each salt meet in one task; positives stay in theirs.
    place = "row_number() over (partition by snapshot, target, lane order by rank, x, y)"
    best = hashed.withColumn("lane", F.pmod(F.xxhash64("x", "y"), F.lit(16))).withColumn("place", F.expr(place)).where((F.col("target") == 1) | (F.col("place") <= cap))
    kept = best.withColumn("lane", F.when(F.col("target") == 1, F.col("lane")).otherwise(-1)).withColumn("place", F.expr(place)).where((F.col("target") == 1) | (F.col("place") <= cap))
    return kept.drop("rank", "lane", "place")


def unscored_positives(candidates: DataFrame, positives: DataFrame) -> DataFrame:
    """Positives that no candidate covers."""
    return positives.join(candidates.select("snapshot", "x", "y"), ["snapshot", "x", "y"], "left_anti")


def fire_state(cells: DataFrame, detections: DataFrame, lookback_h: int = 24, lag_h: int = 3) -> DataFrame:
    """Centre and 3 x 3 evidence for every row of ``cells``; nulls, not zeros, where there is none.

    The example side is exploded to its nine cells, a detection to the one or two stretches of time, as long as the
    lookback, in which cutoffs may see it; they meet on cell and stretch, so a cell's years don't meet each other. One
    aggregation per example follows. Detections are distinct by id; rows of one id that differ stop the job.
    """
    keys = ["x", "y", "anchor_at"]
    around = F.array(*(F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)))
    examples = cells.select(*keys).distinct()
    near = examples.select(*keys, F.explode(around).alias("o")).select(*keys, (F.col("x") + F.col("o.dx")).alias("nx"), (F.col("y") + F.col("o.dy")).alias("ny"))
    d = detections.select(F.col("x").alias("nx"), F.col("y").alias("ny"), "detection_id", "acquired_at", "bright_ti4", "product")
    d = once_by_id(d, "detection_id").withColumn("stretch", F.explode(stretches("acquired_at", lookback_h, lag_h)))
    seen = near.withColumn("stretch", stretch("anchor_at", lookback_h)).join(d, ["nx", "ny", "stretch"]).where(_gate(F.col("acquired_at"), F.col("anchor_at"), lookback_h, lag_h))
    centre = (F.col("nx") == F.col("x")) & (F.col("ny") == F.col("y"))
    age = (F.unix_micros("anchor_at") - F.unix_micros(F.max("acquired_at"))) / 3.6e9
    stats = seen.groupBy(*keys).agg(
        F.count_if(centre).alias("center_count"),
        F.max(F.when(centre, F.col("bright_ti4"))).alias("center_max"),
        F.avg(F.when(centre, F.col("bright_ti4"))).alias("center_mean"),
        F.count("*").alias("local_count"),
        F.max("bright_ti4").alias("local_max"),
        F.avg("bright_ti4").alias("local_mean"),
        F.countDistinct("product").alias("local_platforms"),
        F.countDistinct("nx", "ny").alias("local_active_cells"),
        age.alias("local_hours_since"),
    )
    counts = ["center_count", "local_count", "local_platforms", "local_active_cells"]
    return examples.join(stats, keys, "left").fillna(0, counts)


def current_state(detections: DataFrame, now: Column, youngest_h: int = 3, oldest_h: int = 24) -> DataFrame:
    """Per cell at ``now``: distinct detections aged within the window, products, brightness, age; of repeats the brightest counts."""
    fresh = detections.where(_gate(F.col("acquired_at"), now, oldest_h, youngest_h))
    fresh = fresh.groupBy("product", "x", "y", "latitude", "longitude", "acquired_at").agg(F.max("bright_ti4").alias("bright_ti4"))
    return fresh.groupBy("x", "y").agg(
        F.count("*").alias("n"),
        F.countDistinct("product").alias("platforms"),
        F.avg("bright_ti4").alias("mean_bright"),
        ((F.unix_micros(now) - F.unix_micros(F.max("acquired_at"))) / 3.6e9).alias("age_h"),
    )


def snapshot_states(detections: DataFrame, youngest_h: int = 3, oldest_h: int = 24) -> DataFrame:
    """``current_state`` at every 12-hour snapshot: each detection explodes to the snapshots of its own window."""
    own = detections.groupBy("product", "x", "y", "latitude", "longitude", "acquired_at").agg(F.max("bright_ti4").alias("bright_ti4"))
    times = F.expr(f"sequence(date_trunc('day', acquired_at), acquired_at + interval {oldest_h} hours, interval 12 hours)")
    met = own.select("*", F.explode(times).alias("snapshot")).where(_gate(F.col("acquired_at"), F.col("snapshot"), oldest_h, youngest_h))
    return met.groupBy("snapshot", "x", "y").agg(
        F.count("*").alias("n"),
        F.countDistinct("product").alias("platforms"),
        F.avg("bright_ti4").alias("mean_bright"),
        ((F.unix_micros("snapshot") - F.unix_micros(F.max("acquired_at"))) / 3.6e9).alias("age_h"),
    )


def in_box(points: DataFrame, west: float, south: float, east: float, north: float) -> DataFrame:
    """Points within a box of degrees; all four sides belong."""
    return points.where(F.col("longitude").between(west, east) & F.col("latitude").between(south, north))


def snapshot_reports(detections: DataFrame, bounds: tuple[float, float, float, float] | None = None, youngest_h: int = 3, oldest_h: int = 24) -> DataFrame:
    """Per 12-hour snapshot, in a box: detections of an age that counts, younger ones that don't count yet, and active cells.

    Detections of one product, place and time are one. A snapshot without any detection of its window has no row.
    """
    held = detections if bounds is None else in_box(detections, *bounds)
    own = held.select("product", "latitude", "longitude", "acquired_at", "x", "y").distinct()
    times = F.expr(f"sequence(date_trunc('day', acquired_at), acquired_at + interval {oldest_h} hours, interval 12 hours)")
    met = own.select("*", F.explode(times).alias("snapshot")).where(F.col("acquired_at") <= F.col("snapshot"))
    old = _gate(F.col("acquired_at"), F.col("snapshot"), oldest_h, youngest_h)
    # Cells are counted first, so a snapshot's distinct cells are a plain count.
    cells = met.groupBy("snapshot", "x", "y").agg(F.count_if(old).alias("n"), F.count_if(~old).alias("young"))
    return cells.groupBy("snapshot").agg(F.sum("n").alias("eligible_detection_count"), F.sum("young").alias("recent_detections_excluded"), F.count_if(F.col("n") > 0).alias("active_cell_count"))


def tile_buckets(detections: DataFrame, metres: float = 50_000.0, runs_h: int = 6, lag_h: int = 3, reach_h: int = 24, cap: int = 32) -> DataFrame:
    """Forecast tile plan: per model run the best-scored tiles; capped ones are kept with a reason.

    A detection feeds the runs from its availability to ``reach_h`` after it.
    """
    tx, ty = grid.mercator_tile("latitude", "longitude", metres)
    step = runs_h * 3600
    run0 = F.expr(f"cast(ceil((unix_seconds(acquired_at) + {lag_h * 3600}) / {step}) as bigint)")
    run1 = F.expr(f"cast(floor((unix_seconds(acquired_at) + {reach_h * 3600}) / {step}) as bigint)")
    runs = detections.select("detection_id", "acquired_at", "bright_ti4", F.expr(f"{tx} as tx"), F.expr(f"{ty} as ty"), F.explode(F.sequence(run0, run1)).alias("run"))
    tiles = runs.groupBy("run", "tx", "ty").agg(
        F.count("*").alias("n"), F.max("bright_ti4").alias("max_bright"), F.max("acquired_at").alias("latest"), F.max_by("detection_id", F.struct("bright_ti4", "detection_id")).alias("representative")
    )
    scored = tiles.withColumn("age_h", F.expr(f"(run * {step} - unix_seconds(latest)) / 3600e0")).withColumn("score", F.expr(grid.evidence_score("max_bright", "n", "age_h")))
    ranked = scored.withColumn("place", F.expr("row_number() over (partition by run order by score desc, tx, ty)"))
    return ranked.withColumn("reason", F.when(F.col("place") > cap, "per-run-tile-cap").otherwise("selected")).drop("latest")
