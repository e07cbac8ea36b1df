"""One-step frontier operators over many scenarios at once: candidates, growth cap, advance, mix, lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderspan.functions import grid
from cinderspan.operators.evaluate import intensity
from cinderspan.operators.fire import stretch, stretches
from cinderspan.operators.records import require


def neighbours(cells: DataFrame, radius: int, keep_centre: bool = True) -> DataFrame:
    """Every row once for each cell within ``radius`` (a square), ``x, y`` moved there."""
    steps = F.sequence(F.lit(-radius), F.lit(radius))
    rest = [c for c in cells.columns if c not in ("x", "y")]
    moved = cells.select("*", F.explode(steps).alias("_dx")).select("*", F.explode(steps).alias("_dy"))
    if not keep_centre:
        moved = moved.where("_dx <> 0 OR _dy <> 0")
    return moved.select(*rest, (F.col("x") + F.col("_dx")).alias("x"), (F.col("y") + F.col("_dy")).alias("y"))


def frontier_candidates(active: DataFrame, burned: DataFrame, key: str = "scenario", radius: int = 1, allowed: Column | None = None) -> DataFrame:
    """Cells around active ones that are neither active nor burned, with the strongest neighbour; with ``allowed``, only cells (``x, y``) for which it holds.

    ``active`` has ``key, x, y, intensity``. Neighbours are combined before the shuffle.
    """
    cell = [key, "x", "y"]
    near = neighbours(active.select(*cell, "intensity"), radius, keep_centre=False)
    if allowed is not None:
        near = near.where(allowed)
    near = near.groupBy(*cell).agg(F.max("intensity").alias("neighbour_intensity"), F.count("*").alias("active_neighbours"))
    taken = active.select(*cell).unionByName(burned.select(*cell))
    return near.join(taken, cell, "left_anti")


def strongest_candidates(front: DataFrame, key: str = "scenario", most: int = 5000, salts: int = 32) -> DataFrame:
    """Per scenario the ``most`` candidates with the strongest neighbours, ties by cell id, with their ``place``.

    Shares of a scenario are ranked first, so that none is one task whole; at most ``salts * most`` rows
    of a scenario meet in the last one.
    """
    salted = front.withColumn("_s", F.expr(f"pmod(hash(x, y), {salts})")).withColumn("_id", F.expr(grid.cell_id("x", "y")))
    order = "order by neighbour_intensity desc, _id"
    best = salted.withColumn("_p", F.expr(f"row_number() over (partition by {key}, _s {order})")).where(F.col("_p") <= most)
    return best.withColumn("place", F.expr(f"row_number() over (partition by {key} {order})")).where(F.col("place") <= most).drop("_s", "_id", "_p")


def frontier_rows(rows: DataFrame, flag: str = "firms_center_has_detection") -> DataFrame:
    """Rows whose centre has no detection; a flag that is neither 0 nor 1 stops the job."""
    binary = F.col(flag).isin(0, 1)
    return rows.where(F.when(F.coalesce(binary, F.lit(False)), F.col(flag) == 0).otherwise(F.raise_error(F.lit(f"{flag} must be 0 or 1"))))


def seeds_from_points(points: DataFrame, key: str = "scenario") -> DataFrame:
    """First state of points (``key, x, y, intensity``): the strongest of each cell."""
    return points.groupBy(key, "x", "y").agg(F.max("intensity").alias("intensity"))


def scored_candidates(features: DataFrame, estimator, column: str = "probability") -> DataFrame:
    """``features`` with the ``probability`` of anything that scores frames: a column, or an object with ``score`` (such as a spread model) or ``transform``.

    What isn't a number from 0 to 1 stops the job.
    """
    if isinstance(estimator, Column):
        out = features.withColumn(column, estimator)
    else:
        out = estimator.score(features) if hasattr(estimator, "score") else estimator.transform(features)
    return require(out, {f"{column} is valid": F.col(column).between(0.0, 1.0) & ~F.isnan(column)})


def capped_ignitions(scored: DataFrame, active: DataFrame, key: str = "scenario", threshold: float = 0.05, growth: float = 0.5, most: int = 128) -> DataFrame:
    """Candidates at or above ``threshold``: per scenario min(most, ceil(growth * active)), likeliest first.

    The constant bound on the rank lets each task keep its best ``most`` rows before the shuffle.
    """
    place = f"row_number() over (partition by {key} order by probability desc, x, y)"
    best = scored.where(F.col("probability") >= threshold).withColumn("_place", F.expr(place)).where(F.col("_place") <= most)
    limits = active.groupBy(key).agg(F.ceil(F.count("*") * growth).alias("_limit"))
    return best.join(limits, key).where("_place <= _limit").drop("_place", "_limit")


def advance_state(active: DataFrame, ignitions: DataFrame, key: str = "scenario", retention: float = 0.85, active_steps: int = 2) -> DataFrame:
    """The state one step later: ``key, x, y, intensity, age_steps, status``.

    Survivors age by a step and are burned after ``active_steps``; new cells take ``retention`` of
    their strongest neighbour.
    """
    cell = [key, "x", "y"]
    old = active.select(*cell, "intensity", (F.col("age_steps") + 1).cast("int").alias("age_steps"))
    new = ignitions.select(*cell, (F.col("neighbour_intensity") * retention).alias("intensity"), F.lit(0).alias("age_steps"))
    return old.unionByName(new).withColumn("status", F.when(F.col("age_steps") < active_steps, "active").otherwise("burned"))


def state_mix(observed: DataFrame, predicted: DataFrame, fraction: float, key: str = "scenario", seed: str = "mix") -> DataFrame:
    """Per cell of either side the hash picks predicted (a share of ``fraction``) or observed.

    A cell that the picked side lacks is absent. Both sides have ``key, x, y, intensity``.
    """
    cell = [key, "x", "y"]
    both = observed.select(*cell, F.struct("intensity").alias("o")).join(predicted.select(*cell, F.struct("intensity").alias("p")), cell, "full_outer")
    name = f"concat('{seed}:', cast({key} as string), ':', {grid.cell_id('x', 'y')})"
    picked = both.withColumn("predicted", F.expr(f"{grid.stable_fraction(name)} < {grid.num(fraction)}"))
    picked = picked.select(*cell, "predicted", F.when(F.col("predicted"), F.col("p")).otherwise(F.col("o")).alias("s"))
    return picked.where("s IS NOT NULL").select(*cell, "predicted", "s.intensity")


#: Side, in cells, of the blocks on which cells meet detections.
SEED_BLOCK = 4


def seed_lineage(cells: DataFrame, detections: DataFrame, radius: int = 2, retained: int = 128, lookback_h: int = 24, lag_h: int = 3) -> DataFrame:
    """Eligible detections within ``radius`` of every row of ``cells`` (``snapshot, x, y, anchor_at``).

    Ids are distinct and sorted: the first ``retained``, their number, whether that cut any, and
    the digest of all. Rows without one have none.
    """
    # Block of cells and stretch of time make the key, so a cell's years don't meet each other and a detection
    # is dealt to the few blocks within its radius, not to every cell. Dealt ones are many more than their file suggests: no broadcast.
    block = lambda v: f"cast(floor(({v}) / {SEED_BLOCK}) as int)"
    dealt = detections.select(F.col("x").alias("ox"), F.col("y").alias("oy"), "acquired_at", "detection_id").withColumn("stretch", F.explode(stretches("acquired_at", lookback_h, lag_h)))
    for a in "xy":
        dealt = dealt.withColumn(f"b{a}", F.explode(F.expr(f"sequence({block(f'o{a} - {radius}')}, {block(f'o{a} + {radius}')})")))
    own = cells.select("snapshot", "x", "y", "anchor_at", stretch("anchor_at", lookback_h).alias("stretch"), *(F.expr(block(a)).alias(f"b{a}") for a in "xy"))
    gate = f"acquired_at between anchor_at - interval {lookback_h} hours and anchor_at - interval {lag_h} hours"
    met = own.join(dealt.hint("merge"), ["bx", "by", "stretch"]).where(f"abs(x - ox) <= {radius} and abs(y - oy) <= {radius} and {gate}")
    ids = met.groupBy("snapshot", "x", "y").agg(F.sort_array(F.collect_set("detection_id")).alias("ids"))
    return ids.select(
        "snapshot", "x", "y", F.size("ids").alias("n_seeds"), F.slice("ids", 1, retained).alias("seeds"), (F.size("ids") > retained).alias("truncated"), F.sha2(F.array_join("ids", "\x1f"), 256).alias("seeds_sha256")
    )


def observed_state(cells: DataFrame, key: str = "scenario", youngest_h: float = 3, oldest_h: float = 24) -> DataFrame:
    """Active cells of observed centres (``key, x, y, n, brightness, age_h``): seen, and of an age that counts; brightest per cell."""
    own = cells.where((F.col("n") > 0) & F.col("age_h").between(youngest_h, oldest_h))
    return own.groupBy(key, "x", "y").agg(F.max(intensity("brightness")).alias("intensity"), F.min("age_h").alias("age_h"))


def frontier_features(frontier: DataFrame, active: DataFrame, key: str = "scenario", youngest_h: float = 3, oldest_h: float = 24) -> DataFrame:
    """Local features of frontier cells from active ones (``intensity, age_h, detections, platforms``) in their 3 x 3 block.

    Only evidence of an age that counts is seen. Brightness is that of the intensity, its mean weighted by
    detections; without evidence it is null and counts are zero.
    """
    seen = active.where(F.col("age_h").between(youngest_h, oldest_h)).withColumn("bright", 305 + 62 * F.col("intensity"))
    near = neighbours(seen.select(key, "x", "y", "bright", "age_h", "detections", "platforms"), 1)
    stats = near.groupBy(key, "x", "y").agg(
        F.sum("detections").alias("local_count"), F.max("bright").alias("local_max"), (F.sum(F.col("bright") * F.col("detections")) / F.sum("detections")).alias("local_mean"),
        F.max("platforms").alias("local_platforms"), F.min("age_h").alias("local_hours_since"), F.count("*").alias("local_active_cells"),
    )
    met = frontier.select(key, "x", "y").join(stats, [key, "x", "y"], "left")
    return met.fillna(0, ["local_count", "local_platforms", "local_active_cells"]).withColumn("local_has", (F.col("local_active_cells") > 0).cast("int"))


#: Fixed names of the terrain columns that a model reads.
TERRAIN_FLAGS = ("terrain_valid", "terrain_aspect_defined")
TERRAIN_VALUES = ("terrain_elevation_m", "terrain_slope_degrees", "terrain_aspect_sin", "terrain_aspect_cos")


def with_terrain(rows: DataFrame, terrain: DataFrame) -> DataFrame:
    """``rows`` with the terrain of their cell (``x, y``): flags as 0 or 1, values null where terrain is missing or not valid.

    ``terrain`` has a row for each cell. A valid cell with a value that is null or not finite stops the job.
    """
    valid = F.coalesce(F.col("terrain_valid").cast("boolean"), F.lit(False))
    finite = F.lit(True)
    for c in TERRAIN_VALUES:
        finite = finite & F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))
    known = require(terrain.select("x", "y", *TERRAIN_FLAGS, *(F.col(c).cast("double").alias(c) for c in TERRAIN_VALUES)), {"finite terrain": ~valid | finite})
    known = known.withColumns({c: F.when(valid, F.col(c)) for c in TERRAIN_VALUES})
    flags = {"terrain_aspect_defined": (valid & F.coalesce(F.col("terrain_aspect_defined").cast("boolean"), F.lit(False))).cast("double"), "terrain_valid": valid.cast("double")}
    return rows.join(known.withColumns(flags), ["x", "y"], "left").fillna(0.0, list(TERRAIN_FLAGS))


def pair_report(candidates: DataFrame, domain: DataFrame, key: str = "scenario", target: str = "target") -> DataFrame:
    """Per pair of steps: candidates in the next domain, domain rows not reached, candidates outside, and the positives of each."""
    met = candidates.select(key, "x", "y").distinct().withColumn("_c", F.lit(1)).join(domain.select(key, "x", "y", F.col(target).alias("_y")), [key, "x", "y"], "full")
    here, there = F.col("_c").isNotNull(), F.col("_y").isNotNull()
    return met.groupBy(key).agg(
        F.count_if(here & there).alias("matched"), F.count_if(here & there & (F.col("_y") == 1)).alias("matched_positives"),
        F.count_if(~here & there).alias("unreached"), F.count_if(~here & there & (F.col("_y") == 1)).alias("unreached_positives"), F.count_if(here & ~there).alias("outside"),
    )


def fragments(sequences: DataFrame, key: list[str], steps: int = 8, fractions: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Places of sequences (``place`` from 1) in pieces of ``steps``: piece, offset, and the share of predicted state there (none at 0)."""
    offset = F.col("place") - 1
    rise = F.least(F.lit(len(fractions) - 1), F.floor((F.col("offset") - 1) * len(fractions) / (steps - 1)).cast("int"))
    placed = sequences.select("*", F.floor(offset / steps).cast("int").alias("fragment"), (offset % steps).cast("int").alias("offset"))
    return placed.withColumn("predicted_fraction", F.when(F.col("offset") > 0, F.element_at(F.array(*map(F.lit, fractions)), rise + 1)))


def capped_sample(rows: DataFrame, id_col: str, observed: int, share: float = 0.5, seed: str = "0") -> DataFrame:
    """The rows with the lowest hash, at most a share of the observed ones: a sample that comes out the same again."""
    rank = F.expr(grid.stable_fraction(f"concat('{seed}:subset:', cast({id_col} as string))"))
    return rows.withColumn("_rank", rank).orderBy("_rank", id_col).limit(int(observed * share)).drop("_rank")


def cumulative(cells: DataFrame, key: str, step: str, steps: DataFrame) -> DataFrame:
    """Distinct cells seen up to each step, as counts: from each cell's first step, so no set grows."""
    first = cells.groupBy(key, "x", "y").agg(F.min(step).alias(step)).groupBy(key, step).agg(F.count("*").alias("n_new"))
    met = steps.select(key, step).distinct().join(first, [key, step], "left").fillna(0, ["n_new"])
    return met.withColumn("n_seen", F.expr(f"sum(n_new) over (partition by {key} order by {step})"))
