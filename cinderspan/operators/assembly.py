"""Rows of training tables and what goes with them: assembled examples, coverage ids, cell lineage, one-step augmentation, plans as text, merged builds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspan.functions import grid
from cinderspan.operators import frontier, records, views

# What a row says of weather that it doesn't have, and of its use.
NO_WEATHER = {"weather_available": 0, "weather_missing_indicator": 1, "weather_feature_status": "unavailable", "weather_missing_reason": "not-collected-for-this-build", "weather_input_policy": "no-weather"}
POSITIVE_ONLY = "positive-only"


def training_rows(labels: DataFrame, state: DataFrame, terrain: DataFrame, build: str, horizon_h: int = 12) -> DataFrame:
    """One row for each label (``x, y, anchor_at`` and its own columns): identity, times, evidence, terrain and explicit missingness.

    ``state`` goes by cell and cutoff, ``terrain`` by cell. A label without evidence of its own cutoff stops the job: counts are zero where
    nothing was seen, so a missing row is an error. Terrain may be missing; its status says so.
    """
    keys = ["x", "y", "anchor_at"]
    own = records.require_once(labels, keys, "one label for each cell and cutoff")
    met = own.join(state.withColumn("_seen", F.lit(True)), keys, "left").join(terrain.withColumn("_land", F.lit(True)), ["x", "y"], "left")
    met = records.require(met, {"the label has evidence": F.col("_seen").isNotNull()})
    cell = grid.cell_id("x", "y")
    end = F.col("anchor_at") + F.expr(f"interval {horizon_h} hours")
    named = {
        "record_type": F.lit("training_example"),
        "build_version": F.lit(build),
        "training_grid": F.lit("naea-1km"),
        "prediction_horizon_hours": F.lit(horizon_h),
        "example_id": records.example_id(F.expr(cell), "anchor_at"),
        "cell_id": F.expr(cell),
        "anchor_text": records.utc_text("anchor_at"),
        "target_end_at": end,
        "terrain_status": F.when(F.col("_land"), "available").otherwise("outside-source"),
        "binary_training_status": F.lit(POSITIVE_ONLY),
        **{k: F.lit(v) for k, v in NO_WEATHER.items()},
    }
    return met.withColumns(named).drop("_seen", "_land")


def coverage_id(*parts: Column | str) -> Column:
    """Name of what is expected to be covered: its parts with colons between; dates and times as UTC text. A missing part makes no name."""
    columns = [F.lit(p) if isinstance(p, str) else p for p in parts]
    missing = columns[0].isNull()
    for c in columns[1:]:
        missing = missing | c.isNull()
    return F.when(~missing, F.concat_ws(":", *columns))


def label_coverage_id(build: str, region: str, source_time: str, mode: str, overlap: float) -> Column:
    return coverage_id("feds-weak-labels", build, F.col(region), records.utc_text(source_time), mode, f"overlap={overlap:.6f}")


def cell_lineage(detections: DataFrame, radius: int = 1) -> DataFrame:
    """Per cell around detections: their number, distinct ids and raw artifacts in order (blank ones left out), the latest time.

    Ids are made distinct by cell before they are gathered; a cell holds those of its own neighbourhood.
    """
    clean = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    near = frontier.neighbours(detections.select("x", "y", "acquired_at", clean("detection_id").alias("d"), clean("raw_artifact_id").alias("r")), radius)
    whole = near.groupBy("x", "y").agg(F.count("*").alias("source_detection_count"), F.max("acquired_at").alias("latest_acquired_at"))
    for c, out in (("d", "source_detection_ids"), ("r", "source_raw_artifact_ids")):
        ids = near.where(F.col(c).isNotNull()).select("x", "y", c).distinct().groupBy("x", "y").agg(F.array_sort(F.collect_list(c)).alias(out))
        whole = whole.join(ids, ["x", "y"], "left").withColumn(out, F.coalesce(out, F.array().cast("array<string>")))
    return whole


def one_step_augmentation(active: DataFrame, burned: DataFrame, examples: DataFrame, estimator, key: str = "scenario", step: str = "interval 12 hours", youngest_h: float = 3, step_h: float = 12) -> tuple[DataFrame, DataFrame]:
    """Frontier rows of the state that one step predicts, where the next snapshot has an example, and a report for each pair of snapshots.

    ``active`` (``key, x, y, intensity, age_steps``) and ``burned`` are observed states of all snapshots, ``examples`` (``key, x, y, example_id, target, flag``)
    the rows of all snapshots. In one plan: candidates around the active cells, their scores (``estimator``: see ``frontier.scored_candidates``), the capped
    ignitions, the state a step later, its candidates with their rendered features, met with the next snapshot's own frontier. Only pairs that both exist count.
    """
    cell = [key, "x", "y"]
    later = lambda df: df.withColumn(key, (F.col(key) + F.expr(step)).cast(df.schema[key].dataType))
    front = frontier.frontier_candidates(active, burned, key)
    lit = frontier.capped_ignitions(frontier.scored_candidates(front, estimator), active, key)
    stepped = frontier.advance_state(active, lit, key)
    now = stepped.where("status = 'active'").withColumns(
        {"age_h": youngest_h + step_h * F.col("age_steps"), "detections": F.greatest(F.lit(1), F.ceil(3 * F.col("intensity"))), "platforms": F.lit(1)}
    )
    gone = burned.select(*cell).unionByName(stepped.where("status = 'burned'").select(*cell))
    second = frontier.frontier_candidates(now, gone, key)
    rows = frontier.frontier_rows(examples, "flag")
    rows = records.require_once(records.require(rows, {"target is 0 or 1": F.col("target").isin(0, 1)}), cell, "one frontier row for each cell of a snapshot")
    # Pairs of a snapshot with a state and the next one with examples.
    pairs = later(active.select(key).distinct()).join(examples.select(key).distinct(), key)
    reached = later(second.select(*cell)).join(pairs, key)
    features = later(frontier.frontier_features(second, now, key))
    matched = rows.join(features, cell).withColumn("synthetic_state_steps", F.lit(1))
    report = frontier.pair_report(reached, rows.join(pairs, key), key)
    return matched, pairs.join(report, key, "left").fillna(0)


def tile_plan_text(plan: DataFrame, model: str, runs_h: int = 6, lag_h: int = 3, reach_h: int = 24) -> DataFrame:
    """A tile plan (``run, tx, ty, n, max_bright, representative, score, place, reason``) as text columns: six decimals, UTC times, empty for none."""
    at = lambda hours: records.utc_text(f"timestamp_seconds(run * {runs_h * 3600} + {hours * 3600})")
    number = lambda c: F.format_string("%.6f", F.col(c).cast("double"))
    chosen = F.col("reason") == "selected"
    return plan.select(
        F.lit(model).alias("model"),
        at(0).alias("model_run_at"),
        F.format_string("webmercator:x=%d:y=%d", F.col("tx").cast("bigint"), F.col("ty").cast("bigint")).alias("tile_id"),
        at(-reach_h).alias("anchor_window_start"),
        at(-lag_h).alias("anchor_window_end"),
        F.col("n").cast("string").alias("candidate_detection_count"),
        number("max_bright").alias("max_bright_ti4"),
        F.col("representative").alias("representative_detection_id"),
        number("score").alias("fire_evidence_score"),
        F.lower(chosen.cast("string")).alias("selected"),
        F.when(chosen, F.col("place").cast("string")).otherwise("").alias("selection_rank"),
        F.when(chosen, "").otherwise(F.col("reason")).alias("non_admission_reason"),
    )


def read_release(spark: SparkSession, path: str, columns: list[str], n_rows: int) -> DataFrame:
    """Columns of a CSV release as text, by name from its header; only these are parsed. Another number of rows than its manifest's stops the read."""
    held = spark.read.csv(path, header=True, inferSchema=False, mode="FAILFAST", emptyValue="")
    if absent := [c for c in columns if c not in held.columns]:
        raise ValueError(f"the release has no columns {absent}")
    found = held.select(*columns)
    if (n := found.count()) != n_rows:
        raise ValueError(f"the release holds {n} rows, its manifest says {n_rows}")
    return found


def merged_builds(spark: SparkSession, builds: DataFrame, key: list[str], first: str, last: str) -> tuple[DataFrame, DataFrame]:
    """The union of contiguous builds and its one-row manifest with counts summed anew.

    ``builds`` has ``build_id, policy, start_on, end_on, path`` and counts ``n_*``, a row for each build. Refused: faults of ``merge_faults``, ends other than
    ``first`` and ``last``, a build whose rows aren't as many as it says (``n_rows``), and a repeated ``key`` across builds.
    """
    if faults := views.merge_faults(builds).collect():  # builds are few
        raise ValueError(f"builds can't be merged: {[tuple(f) for f in faults]}")
    ends = builds.agg(F.min("start_on").alias("a"), F.max("end_on").alias("b")).first()
    if (str(ends["a"]), str(ends["b"])) != (first, last):
        raise ValueError(f"builds span {ends['a']} to {ends['b']}, not {first} to {last}")
    parts = builds.select("build_id", "path", "n_rows").orderBy("start_on").collect()
    rows = None
    for p in parts:
        part = spark.read.parquet(p["path"])
        if (n := part.count()) != p["n_rows"]:
            raise ValueError(f"build {p['build_id']} holds {n} rows, its manifest says {p['n_rows']}")
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    counts = [c for c in builds.columns if c.startswith("n_")]
    manifest = builds.agg(F.min("start_on").alias("start_on"), F.max("end_on").alias("end_on"), F.min("policy").alias("policy"), F.sort_array(F.collect_list("build_id")).alias("merged_from"), *(F.sum(c).alias(c) for c in counts))
    return records.require_once(rows, key, "builds have no snapshot in common"), manifest
