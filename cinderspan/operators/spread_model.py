"""Leakage-safe spread classifier: feature refusals, chronological boosted trees, a sigmoid from other incidents, checked scores."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderspan.functions import grid
from cinderspan.operators import evaluate, records, views
from cinderspan.session import cut, shared_dir

# Names, beginnings, parts and endings of columns that tell of labels, sources, places or times.
EXACT = (
    "example_id", "cell_id", "cell_center_latitude", "cell_center_longitude", "anchor_at", "feature_cutoff_at", "target_end_at", "target_newly_burned_12h", "label_status",
    "label_observability", "label_tier", "label_source", "label_quality_score", "label_build_version", "positive_overlap_fraction", "source_snapshot_time", "target_snapshot_time",
    "source_time_semantics", "time_alignment_mode", "contributing_fire_count", "contributing_fires", "raw_artifact_id", "raw_artifact_ids", "normalized_artifact_id", "split", "fold",
)
PREFIXES = ("label_", "target_", "feds_", "raw_", "provenance_")
PARTS = ("artifact", "geometry", "perimeter", "snapshot", "provenance")
SUFFIXES = ("_id", "_at", "_timestamp")

#: Stands for a missing value: below all real ones, so a tree can tell it apart at its first cut.
MISSING = -1e18


def leak_rule(name: str) -> Column:
    """The rule by which a column of names is refused as features, or null: blank, exact, prefix, suffix or part, in this order."""
    n = F.lower(F.trim(F.col(name)))
    any_of = lambda tests: F.array_contains(F.array(*tests), True)
    return (
        F.when(F.coalesce(n, F.lit("")) == "", "blank")
        .when(n.isin(*EXACT), "exact")
        .when(any_of([F.startswith(n, F.lit(p)) for p in PREFIXES]), "prefix")
        .when(any_of([F.endswith(n, F.lit(s)) for s in SUFFIXES]), "suffix")
        .when(any_of([F.contains(n, F.lit(p)) for p in PARTS]), "part")
    )


def leak_columns(names: list[str]) -> list[str]:
    """Those of ``names`` that may not be features, as they came."""
    out = []
    for name in names:
        n = (name or "").strip().lower()
        if not n or n in EXACT or n.startswith(PREFIXES) or n.endswith(SUFFIXES) or any(p in n for p in PARTS):
            out.append(name)
    return out


def checked_features(df: DataFrame, features: list[str], target: str, *not_inputs: str) -> DataFrame:
    """``df``, refused where the list of features names nothing, a column twice, one that isn't there, the target, a time or group, or
    leaking metadata; where a target isn't 0 or 1; or where a feature is infinite. Missing values (null, nan) are fine."""
    if not features or len(set(features)) < len(features):
        raise ValueError("features must be named, each once")
    if absent := [c for c in (*features, target, *not_inputs) if c not in df.columns]:
        raise ValueError(f"no such columns: {absent}")
    if inner := [c for c in (target, *not_inputs) if c in features]:
        raise ValueError(f"these columns can't be features: {inner}")
    if leaks := leak_columns(features):
        raise ValueError(f"features are leaking metadata: {leaks}")
    finite = {f"{c} is finite": F.coalesce(F.abs(F.col(f"`{c}`").cast("double")) != float("inf"), F.lit(True)) for c in features}
    return records.require(df, {f"{target} is 0 or 1": F.col(f"`{target}`").isin(0, 1)} | finite)


def vectors(df: DataFrame, features: list[str]) -> DataFrame:
    """``df`` with ``_features``; a missing value is MISSING."""
    held = df.withColumns({f"_f{k}": F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")), F.lit(MISSING)) for k, c in enumerate(features)})
    return VectorAssembler(inputCols=[f"_f{k}" for k in range(len(features))], outputCol="_features").transform(held).drop(*(f"_f{k}" for k in range(len(features))))


@dataclass
class SpreadModel:
    """Trees over ``features``, and the sigmoid that turns the logit of their probability into the calibrated one."""

    trees: GBTClassificationModel
    features: list[str]
    slope: float = 1.0
    intercept: float = 0.0

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with ``raw_probability`` and ``probability``; one that is no number from 0 to 1 stops the job."""
        scored = self.trees.transform(vectors(df, self.features)).withColumn("raw_probability", vector_to_array("_p")[1])
        out = scored.withColumn("probability", sigmoid("raw_probability", self.slope, self.intercept)).drop("_features", "_raw", "_p", "_prediction")
        valid = lambda c: F.col(c).between(0.0, 1.0) & ~F.isnan(c)
        return records.require(out, {f"{c} is valid": valid(c) for c in ("raw_probability", "probability")})


def sigmoid(p: str, slope: float, intercept: float) -> Column:
    return 1 / (1 + F.exp(-(F.expr(grid.logit(p)) * slope + intercept)))


def fit_trees(df: DataFrame, features: list[str], target: str, weight: str | None = None, rounds: int = 200, rate: float = 0.08, depth: int = 4, seed: int = 0) -> SpreadModel:
    """Boosted trees on rows that are checked; lineage is cut in the shared folder every ten rounds."""
    df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession))
    trees = GBTClassifier(featuresCol="_features", labelCol="_y", maxIter=rounds, stepSize=rate, maxDepth=depth, seed=seed, checkpointInterval=10)
    if weight:
        trees = trees.setWeightCol(weight)
    rows = vectors(df, features).select("_features", F.col(f"`{target}`").cast("double").alias("_y"), *([F.col(weight).cast("double").alias(weight)] if weight else []))
    fitted = trees.fit(cut(rows, "training-rows"))
    return SpreadModel(fitted.setPredictionCol("_prediction").setRawPredictionCol("_raw").setProbabilityCol("_p"), list(features))


def fit_sigmoid(scores: DataFrame, p: str = "raw_probability", y: str = "y", turns: int = 25) -> tuple[float, float]:
    """Slope and intercept of the logistic regression of ``y`` on the logit of ``p``, with half the slope's square as penalty.

    Newton's steps: each is one aggregate of a row over counts of distinct logits.
    """
    z = F.expr(grid.logit(f"`{p}`"))
    counts = cut(scores.select(z.alias("z"), F.col(y).cast("double").alias("y")).groupBy("z").agg(F.sum("y").alias("pos"), F.count("*").alias("n")), "logits")
    slope = intercept = 0.0
    for _ in range(turns):
        q = 1 / (1 + F.exp(-(F.col("z") * slope + intercept)))
        gap, width = F.col("pos") - F.col("n") * q, F.col("n") * q * (1 - q)
        s = counts.agg(F.sum(gap).alias("g0"), F.sum(gap * F.col("z")).alias("g1"), F.sum(width).alias("h00"), F.sum(width * F.col("z")).alias("h01"), F.sum(width * F.col("z") * F.col("z")).alias("h11")).first()
        hessian = np.array([[s["h11"] + 1, s["h01"]], [s["h01"], s["h00"]]])
        step = np.linalg.solve(hessian, [s["g1"] - slope, s["g0"]])
        slope, intercept = slope + float(step[0]), intercept + float(step[1])
        if np.abs(step).max() < 1e-12:
            break
    return slope, intercept


def calibrated(scores: DataFrame, p: str = "raw_probability", y: str = "y") -> DataFrame:
    """``scores`` with ``probability`` by the sigmoid that fits them."""
    return scores.withColumn("probability", sigmoid(f"`{p}`", *fit_sigmoid(scores, p, y)))


def both_classes(df: DataFrame, target: str, what: str) -> None:
    """Refuse a side that is empty or has one class only."""
    r = df.agg(F.min(target).alias("a"), F.max(target).alias("b")).first()
    if r["a"] is None or r["a"] == r["b"]:
        raise ValueError(f"{what} must hold both classes")


def train_chronological(df: DataFrame, features: list[str], target: str, anchor: str, group: str | None = None, share: float = 0.8, **trees) -> tuple[SpreadModel, DataFrame]:
    """Trees on the first share of the distinct times of ``group`` (or ``anchor``), and the later rows with their scores.

    All rows of a time stay on one side. Metrics and the contract come from the scored rows by the evaluators (``holdout_metrics``).
    """
    group = group or anchor
    parted = cut(evaluate.holdout_masks(checked_features(df, features, target, anchor, group), group, share, target), "parted")
    model = fit_trees(parted.where("part = 'train'"), features, target, **trees)
    return model, model.score(parted.where("part = 'evaluation'"))


def holdout_metrics(scored: DataFrame, target: str, p: str = "probability") -> DataFrame:
    """One row: Brier score, ROC-AUC, average precision, calibration errors, rows and positive rate."""
    s = scored.select(F.lit(0).alias("k"), F.col(target).alias("y"), F.col(p).alias("p"))
    rate = s.groupBy("k").agg(F.avg("y").alias("positive_rate"))
    return evaluate.ranking_metrics(s, ["k"]).join(evaluate.calibration_errors(s, ["k"]).select("k", "ece", "mce"), "k").join(rate, "k").drop("k")


def frontier_rows(df: DataFrame, flag: str = "firms_center_has_detection") -> DataFrame:
    """Rows of cells without a detection of their own; a flag that isn't 0 or 1 stops the job."""
    return records.require(df, {f"{flag} is 0 or 1": F.col(flag).isin(0, 1)}).where(F.col(flag) == 0)


#: What a synthetic row takes over from its parent.
SAME = ("incident_group_id", "cell_id", "source_snapshot_time", "anchor_at", "target_end_at")


def with_synthetic(observed: DataFrame, synthetic: DataFrame, target: str, same: tuple[str, ...] = SAME) -> DataFrame:
    """Observed rows with weight 1 and synthetic ones with their own, columns by name, those of one side null on the other.

    Refused: a synthetic row that isn't of a training incident, a weight outside (0, 1], a parent that is missing, used twice or differs.
    """
    rows = records.require(synthetic, {"synthetic rows train": F.col("incident_split") == "train", "weight": (F.col("sample_weight") > 0) & (F.col("sample_weight") <= 1)})
    faults = views.parent_faults(synthetic, observed, "original_example_id", "example_id", [*same, target]).withColumn("_fault", F.col("fault"))
    rows = records.require(rows.join(faults.select("original_example_id", "_fault").distinct(), "original_example_id", "left"), {"synthetic rows have their parent's lineage": F.col("_fault").isNull()}).drop("_fault")
    return observed.withColumn("sample_weight", F.lit(1.0)).unionByName(rows, allowMissingColumns=True)


def fit_pass(observed: DataFrame, calibration: DataFrame, features: list[str], target: str, synthetic: DataFrame | None = None, anchor: str = "anchor_at", group: str = "source_snapshot_time", **trees) -> tuple[SpreadModel, DataFrame]:
    """Trees on training incidents alone, the sigmoid on calibration incidents alone, and the calibration rows with both scores."""
    train = records.require(checked_features(observed, features, target, anchor, group), {"rows train": F.col("incident_split") == "train"})
    other = records.require(checked_features(calibration, features, target, anchor, group), {"rows calibrate": F.col("incident_split") == "calibration"})
    shared = observed.select("incident_group_id").distinct().join(calibration.select("incident_group_id").distinct(), "incident_group_id", "left_semi")
    if not shared.isEmpty():
        raise ValueError("an incident both trains and calibrates")
    both_classes(train, target, "training")
    both_classes(other, target, "calibration")
    rows = train.withColumn("sample_weight", F.lit(1.0)) if synthetic is None else with_synthetic(train, synthetic, target)
    model = fit_trees(rows, features, target, weight="sample_weight", **trees)
    scored = cut(model.score(other).withColumn("y", F.col(target)), "calibration-scores")
    model.slope, model.intercept = fit_sigmoid(scored)
    return model, scored.withColumn("probability", sigmoid("raw_probability", model.slope, model.intercept)).drop("y")
