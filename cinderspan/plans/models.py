"""Queries of the spread classifier, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cinderspan.functions import grid
from cinderspan.operators import fire, spread_model
from cinderspan.plans.catalog import _selected, query, rounded
from cinderspan.plans.records import duck, made
from cinderspan.sources import adapters

NAMES = """select distinct concat(case user_id % 9 when 0 then 'label' when 1 then 'Target' when 2 then 'firms' when 3 then 'raw' when 4 then 'mean' when 5 then ' slope' when 6 then 'cell' when 7 then 'feds' else 'local' end, '_',
  case event_id % 11 when 0 then 'count' when 1 then 'id' when 2 then 'at' when 3 then 'timestamp' when 4 then 'artifact_n' when 5 then 'Snapshot_age' when 6 then 'score' when 7 then 'degrees' when 8 then 'geometry_m' when 9 then 'center_latitude' else '' end) as name from events"""
_any = lambda test, words: " or ".join(test.format(w=w) for w in words)
D_LEAKS = f"""select name, case when n = '' then 'blank' when n in ({', '.join(f"'{w}'" for w in spread_model.EXACT)}) then 'exact' when {_any("starts_with(n, '{w}')", spread_model.PREFIXES)} then 'prefix'
  when {_any("ends_with(n, '{w}')", spread_model.SUFFIXES)} then 'suffix' when {_any("contains(n, '{w}')", spread_model.PARTS)} then 'part' end as rule from (select name, lower(trim(name)) as n from {duck(NAMES)} q)"""


@query(D_LEAKS)
def leak_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of columns with the rule that refuses them as features."""
    return made(spark, sf_dir, NAMES, "events").select("name", spread_model.leak_rule("name").alias("rule"))


_Z = grid.logit("p")
D_NEWTON = f"""with recursive s as {adapters.oracle('scores')}, z as (select {_Z} as z, sum(y) as pos, count(*) as n from s group by 1),
  it as (select 0 as k, 0e0 as w, 0e0 as b union all select k + 1, w + ((g1 - w) * h00 - g0 * h01) / ((h11 + 1) * h00 - h01 * h01), b + (g0 * (h11 + 1) - (g1 - w) * h01) / ((h11 + 1) * h00 - h01 * h01)
    from (select k, w, b, sum(pos - n * q) as g0, sum((pos - n * q) * z) as g1, sum(n * q * (1 - q)) as h00, sum(n * q * (1 - q) * z) as h01, sum(n * q * (1 - q) * z * z) as h11
      from (select *, 1 / (1 + exp(-(z * w + b))) as q from it, z) group by k, w, b) where k < 20)
  select event_id, y, round(1 / (1 + exp(-({_Z} * w + b))), 6) as probability from s, (select w, b from it where k = 20)"""


@query(D_NEWTON)
def calibrated_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores by the sigmoid that is fitted to them."""
    found = spread_model.calibrated(adapters.derived(spark, sf_dir, "scores").select("event_id", "y", "p"), "p")
    return rounded(found.select("event_id", "y", "probability"), "probability")


def training_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence and target of every selected candidate."""
    cells = _selected(spark, sf_dir)
    state = fire.fire_state(cells, adapters.located(spark, sf_dir))
    return cells.select("snapshot", "x", "y", "anchor_at", "target").join(state, ["x", "y", "anchor_at"])


@query("")
def spread_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of a chronological hold-out of boosted trees over the evidence of all selected candidates."""
    features = ["center_count", "center_max", "local_count", "local_max", "local_mean", "local_platforms", "local_active_cells", "local_hours_since"]
    _, scored = spread_model.train_chronological(training_frame(spark, sf_dir), features, "target", "anchor_at", "snapshot", rounds=10)
    return spread_model.holdout_metrics(scored, "target")
