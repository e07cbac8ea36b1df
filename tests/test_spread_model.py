"""The spread classifier: refusals, hold-outs, weights, calibration and checked scores."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderspan.operators import spread_model

FEATURES = ["firms_count", "mean_slope"]
START = datetime(2026, 7, 1)


@pytest.fixture(scope="module")
def rows(spark):
    """Targets that follow the first feature and, where it is missing, the second one; forty snapshots of twelve incidents."""
    rng = random.Random(6)
    out = []
    for k in range(1200):
        count, slope = (None if rng.random() < 0.2 else float(rng.randint(0, 9))), rng.uniform(0, 30)
        chance = 0.15 + 0.7 * ((count is not None and count > 5) or (count is None and slope > 20))
        incident, at = k % 12, START + timedelta(hours=12 * (k % 40))
        split = "calibration" if incident >= 9 else "train"
        out.append((f"e{k}", f"g{incident}", split, f"c{k}", at, at + timedelta(minutes=k % 7), at + timedelta(hours=12), count, slope, int(rng.random() < chance)))
    names = "example_id string, incident_group_id string, incident_split string, cell_id string, source_snapshot_time timestamp, anchor_at timestamp, target_end_at timestamp, firms_count double, mean_slope double, target int"
    return spark.createDataFrame(out, names).cache()


def test_names_that_leak(spark):
    names = ["firms_count_trailing_12h", "label_quality_score", "feds_event_id", "cell_id", " Anchor_At ", "my_artifact_size", "mean_snapshot_age", "x_timestamp", "slope_deg", "", None, "raw_count", "identity", "fold"]
    want = ["label_quality_score", "feds_event_id", "cell_id", " Anchor_At ", "my_artifact_size", "mean_snapshot_age", "x_timestamp", "", None, "raw_count", "fold"]
    assert spread_model.leak_columns(names) == want
    found = spark.createDataFrame([(n,) for n in names], "name string").withColumn("rule", spread_model.leak_rule("name")).collect()
    assert [r.name for r in found if r.rule] == want


@pytest.mark.parametrize(
    "features, message",
    [([], "each once"), (["firms_count"] * 2, "each once"), (["nothing"], "no such columns"), (["firms_count", "anchor_at"], "can't be features"), (["target"], "can't be features"), (["firms_count", "cell_id"], "leaking metadata")],
)
def test_features_are_refused(rows, features, message):
    with pytest.raises(ValueError, match=message):
        spread_model.checked_features(rows, features, "target", "anchor_at", "source_snapshot_time")


def test_values_are_refused(rows):
    for bad, message in ((rows.withColumn("firms_count", F.lit(float("inf"))), "firms_count is finite"), (rows.withColumn("target", F.lit(2)), "target is 0 or 1"), (rows.withColumn("target", F.lit(None).cast("int")), "target is 0 or 1")):
        with pytest.raises(Exception, match=message):
            spread_model.checked_features(bad, FEATURES, "target", "anchor_at").count()
    assert spread_model.checked_features(rows.withColumn("firms_count", F.lit(float("nan"))), FEATURES, "target").count() == 1200


def test_chronological_holdout_keeps_snapshots_whole_and_learns(rows):
    model, scored = spread_model.train_chronological(rows, FEATURES, "target", "anchor_at", "source_snapshot_time", 0.6, rounds=15)
    ends = scored.agg(F.min("source_snapshot_time").alias("a"), F.count("*").alias("n")).first()
    assert ends.a == START + timedelta(hours=12 * 24) and ends.n == 480
    m = spread_model.holdout_metrics(scored, "target").first()
    assert m.roc_auc > 0.75 and m.average_precision > m.positive_rate + 0.1 and m.n == 480 and 0 <= m.brier < 0.25 and m.mce >= m.ece
    # A missing value is told apart from a small one.
    s = {r.k: r.p for r in scored.groupBy(F.expr("case when firms_count is null then if(mean_slope > 21, 'null-high', 'null-low') when firms_count > 5 then 'high' else 'low' end").alias("k")).agg(F.avg("probability").alias("p")).collect()}
    assert s["null-high"] > s["null-low"] + 0.3 and s["high"] > s["low"] + 0.3
    with pytest.raises(Exception, match="one class"):
        spread_model.train_chronological(rows.withColumn("target", F.when(F.col("source_snapshot_time") > START + timedelta(days=12), 1).otherwise(F.col("target"))), FEATURES, "target", "anchor_at", "source_snapshot_time", 0.8, rounds=1)


def test_sigmoid_is_the_penalised_maximum(spark):
    rng = random.Random(3)
    data = [(p, int(rng.random() < 1 / (1 + math.exp(-(2 * math.log(p / (1 - p)) - 1))))) for p in (rng.uniform(0.02, 0.98) for _ in range(600))]
    slope, intercept = spread_model.fit_sigmoid(spark.createDataFrame(data, "raw_probability double, y int"))
    z, y = np.array([math.log(p / (1 - p)) for p, _ in data]), np.array([v for _, v in data])

    def loss(w, b):
        t = z * w + b
        return np.logaddexp(0, t).sum() - (y * t).sum() + 0.5 * w * w

    best = loss(slope, intercept)
    assert 1.4 < slope < 2.6 and all(loss(slope + a, intercept + b) > best for a in (-1e-3, 0, 1e-3) for b in (-1e-3, 0, 1e-3) if a or b)


def test_second_pass_with_weighted_synthetic_rows(rows):
    train, calibration = rows.where("incident_split = 'train'"), rows.where("incident_split = 'calibration'")
    synthetic = train.limit(60).select("*", F.col("example_id").alias("original_example_id"), F.lit(0.5).alias("sample_weight")).withColumn("example_id", F.concat(F.lit("s"), "example_id")).drop("mean_slope")
    mixed = spread_model.with_synthetic(train, synthetic, "target")
    assert mixed.count() == 960 and mixed.agg(F.sum("sample_weight")).first()[0] == 930 and mixed.where("mean_slope is null").count() == 60
    model, scored = spread_model.fit_pass(train, calibration, FEATURES, "target", synthetic, rounds=8)
    before, after = (spread_model.holdout_metrics(scored, "target", p).first() for p in ("raw_probability", "probability"))
    assert scored.count() == 300 and after.brier <= before.brier + 1e-3 and after.roc_auc == pytest.approx(before.roc_auc)
    again = model.score(calibration).select("example_id", "probability").join(scored.select("example_id", F.col("probability").alias("q")), "example_id")
    assert again.where("abs(probability - q) > 1e-12").count() == 0
    for bad, message in (
        (synthetic.withColumn("sample_weight", F.lit(0.0)), "weight"),
        (synthetic.withColumn("incident_split", F.lit("calibration")), "synthetic rows train"),
        (synthetic.withColumn("original_example_id", F.lit("e0")), "parent's lineage"),
        (synthetic.withColumn("cell_id", F.lit("other")), "parent's lineage"),
        (synthetic.withColumn("original_example_id", F.concat(F.lit("no"), "example_id")), "parent's lineage"),
    ):
        with pytest.raises(Exception, match=message):
            spread_model.with_synthetic(train, bad, "target").count()
    with pytest.raises(ValueError, match="both trains and calibrates"):
        spread_model.fit_pass(train, calibration.withColumn("incident_group_id", F.lit("g1")), FEATURES, "target", rounds=1)
    with pytest.raises(ValueError, match="both classes"):
        spread_model.fit_pass(train, calibration.where("target = 1"), FEATURES, "target", rounds=1)
    with pytest.raises(Exception, match="rows calibrate"):
        spread_model.fit_pass(train, calibration.withColumn("incident_split", F.lit("train")), FEATURES, "target", rounds=1)


def test_scores_are_checked_and_frontier_flags_are_binary(spark, rows):
    model, _ = spread_model.train_chronological(rows, FEATURES, "target", "anchor_at", rounds=1)
    model.slope = float("nan")
    with pytest.raises(Exception, match="probability is valid"):
        model.score(rows).count()
    flags = spark.createDataFrame([(0,), (1,), (0,)], "firms_center_has_detection int")
    assert spread_model.frontier_rows(flags).count() == 2
    with pytest.raises(Exception, match="is 0 or 1"):
        spread_model.frontier_rows(flags.unionByName(spark.createDataFrame([(3,)], flags.schema))).count()
