"""Queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspan.functions import grid
from cinderspan.operators import evaluate, fire, ledger, spatial
from cinderspan.operators.components import connected_components
from cinderspan.session import cut, table
from cinderspan.sources import adapters

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

PURCHASE = "event_type = 'purchase'"
LON = grid.centre_lon("x", "y")
#: DuckDB: the cutoff of a cell, and the availability gate.
D_CUTOFF = f"snapshot + to_microseconds(cast(round_even(({grid.num(1.5)} - {LON} / 15) * {grid.num(3.6e9)}, 0) as bigint))"
D_GATE = "acquired_at >= anchor_at - interval 24 hours and acquired_at <= anchor_at - interval 3 hours"


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in names})


@query(
    f"""select detection_id, x, y, {grid.cell_id('x', 'y')} as cell_id, {grid.region_key('x', 'y')} as region_key,
    round({LON}, 6) as centre_lon, round({grid.centre_lat('x', 'y')}, 6) as centre_lat from {adapters.located_oracle()} d"""
)
def detections_located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every detection's cell, id, region and cell centre."""
    return adapters.located(spark, sf_dir).selectExpr(
        "detection_id", "x", "y", f"{grid.cell_id('x', 'y')} as cell_id", f"{grid.region_key('x', 'y')} as region_key", f"round({LON}, 6) as centre_lon", f"round({grid.centre_lat('x', 'y')}, 6) as centre_lat"
    )


def _positives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells where a purchase event falls within 12 h after the cutoff of a snapshot."""
    d = adapters.located(spark, sf_dir).where(PURCHASE).select("x", "y", "acquired_at").distinct()
    times = F.sequence(F.expr("date_trunc('day', acquired_at - interval 26 hours)"), F.col("acquired_at"), F.expr("interval 12 hours"))
    near = d.select("x", "y", "acquired_at", F.explode(times).alias("snapshot")).withColumn("anchor_at", fire.cutoff())
    return near.where("acquired_at > anchor_at and acquired_at <= anchor_at + interval 12 hours").select("snapshot", "x", "y", "anchor_at").distinct()


D_TIMES = "select t.snapshot from (select min(cast(ts as date)) a, max(cast(ts as date)) b from events) e, generate_series(cast(a as timestamp) - interval 3 days, cast(b as timestamp) + interval 3 days, interval 12 hours) t(snapshot)"
D_CELLS = f"""located as (select * from {adapters.located_oracle()} l0), times as ({D_TIMES}),
seeds as (select distinct x, y, acquired_at from located),
grown as (select snapshot, acquired_at, x + dx as x, y + dy as y from seeds
  join times on acquired_at between snapshot - interval 48 hours and snapshot + interval 48 hours, range(-2, 3) a(dx), range(-2, 3) b(dy)),
cand as (select distinct snapshot, cast(x as int) as x, cast(y as int) as y, {D_CUTOFF} as anchor_at from grown where acquired_at >= {D_CUTOFF} - interval 24 hours and acquired_at <= {D_CUTOFF} - interval 3 hours),
pos as (select distinct snapshot, x, y, {D_CUTOFF} as anchor_at from (select x, y, acquired_at from located where {PURCHASE}) p
  join times on acquired_at between snapshot - interval 48 hours and snapshot + interval 48 hours
  where acquired_at > {D_CUTOFF} and acquired_at <= {D_CUTOFF} + interval 12 hours)"""
D_SELECTED = f"""{D_CELLS}, ranked as (select c.*, row_number() over (partition by c.snapshot order by
    sha256(concat(strftime(c.snapshot, '%Y-%m-%d %H:%M:%S'), '|', {grid.cell_id('c.x', 'c.y')})), c.x, c.y) as place
  from cand c anti join pos p on c.snapshot = p.snapshot and c.x = p.x and c.y = p.y),
selected as (select c.snapshot, c.x, c.y, c.anchor_at, 1 as target from cand c semi join pos p on c.snapshot = p.snapshot and c.x = p.x and c.y = p.y
  union all select snapshot, x, y, anchor_at, 0 from ranked where place <= 2000)"""


@query(f"with {D_SELECTED} select snapshot, x, y, anchor_at, target from selected")
def candidates_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate expansion, supported positives and the capped proxies of every snapshot."""
    return fire.select_candidates(fire.expand_candidates(adapters.located(spark, sf_dir)), _positives(spark, sf_dir))


@query(f"with {D_CELLS} select p.snapshot, p.x, p.y, p.anchor_at from pos p anti join cand c on c.snapshot = p.snapshot and c.x = p.x and c.y = p.y")
def positives_unscored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fire.unscored_positives(fire.expand_candidates(adapters.located(spark, sf_dir)), _positives(spark, sf_dir))


@query(
    f"""with {D_CELLS}, n as (select snapshot, count(*) as n_candidates from cand group by 1),
    m as (select c.snapshot, count(*) as n_supported from cand c semi join pos p on c.snapshot = p.snapshot and c.x = p.x and c.y = p.y group by 1),
    q as (select snapshot, count(*) as n_positives from pos group by 1)
    select snapshot, coalesce(n_candidates, 0) as n_candidates, coalesce(n_positives, 0) as n_positives, coalesce(n_supported, 0) as n_supported from n full join q using (snapshot) left join m using (snapshot)"""
)
def snapshot_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per snapshot: candidates, positives, and positives that candidates cover."""
    keys = ["snapshot", "x", "y"]
    both = fire.expand_candidates(adapters.located(spark, sf_dir)).select(*keys, F.lit(1).alias("c")).join(_positives(spark, sf_dir).select(*keys, F.lit(1).alias("p")), keys, "full")
    return both.groupBy("snapshot").agg(F.count("c").alias("n_candidates"), F.count("p").alias("n_positives"), F.count_if(F.col("c").isNotNull() & F.col("p").isNotNull()).alias("n_supported"))


@query(
    f"""with {D_CELLS}, near as (select p.x, p.y, p.anchor_at, d.* exclude (x, y), d.x = p.x and d.y = p.y as centre, d.x as dx, d.y as dy
      from (select distinct x, y, anchor_at from pos) p join located d on d.x between p.x - 1 and p.x + 1 and d.y between p.y - 1 and p.y + 1 where {D_GATE}),
    s as (select x, y, anchor_at, count(*) filter (centre) as center_count, max(bright_ti4) filter (centre) as center_max, avg(bright_ti4) filter (centre) as center_mean,
      count(*) as local_count, max(bright_ti4) as local_max, avg(bright_ti4) as local_mean, count(distinct product) as local_platforms,
      count(distinct dx * 100000 + dy) as local_active_cells, (epoch_us(anchor_at) - epoch_us(max(acquired_at))) / 3.6e9 as h from near group by 1, 2, 3)
    select p.x, p.y, p.anchor_at, coalesce(center_count, 0) as center_count, round(center_max, 6) as center_max, round(center_mean, 6) as center_mean, coalesce(local_count, 0) as local_count,
      round(local_max, 6) as local_max, round(local_mean, 6) as local_mean, coalesce(local_platforms, 0) as local_platforms, coalesce(local_active_cells, 0) as local_active_cells, round(h, 6) as local_hours_since
    from (select distinct x, y, anchor_at from pos) p left join s using (x, y, anchor_at)"""
)
def fire_state_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centre and 3 x 3 evidence of every positive cell and cutoff."""
    out = fire.fire_state(_positives(spark, sf_dir), adapters.located(spark, sf_dir))
    return rounded(out, "center_max", "center_mean", "local_max", "local_mean", "local_hours_since")


def _selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every selected candidate, supported positives and proxies alike."""
    return fire.select_candidates(fire.expand_candidates(adapters.located(spark, sf_dir)), _positives(spark, sf_dir))


def over_selected(name: str) -> str:
    """The SQL of a query over positives, for all selected candidates."""
    return _SQL[name].replace(D_CELLS, D_SELECTED).replace("from pos p", "from selected p").replace("anchor_at from pos)", "anchor_at from selected)")


@query(over_selected("fire_state_features"))
def fire_state_features_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centre and 3 x 3 evidence of the cell and cutoff of every selected candidate."""
    out = fire.fire_state(_selected(spark, sf_dir), adapters.located(spark, sf_dir))
    return rounded(out, "center_max", "center_mean", "local_max", "local_mean", "local_hours_since")


@query(
    f"""with d as (select distinct on (product, latitude, longitude, acquired_at) * from {adapters.located_oracle()} l where acquired_at between timestamp '2024-01-14 12:00:00' and timestamp '2024-01-15 09:00:00')
    select x, y, count(*) as n, count(distinct product) as platforms, round(avg(bright_ti4), 6) as mean_bright, round((epoch_us(timestamp '2024-01-15 12:00:00') - epoch_us(max(acquired_at))) / 3.6e9, 6) as age_h from d group by 1, 2"""
)
def current_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of every cell at noon on 15 January 2024. Of repeated detections the brightest counts."""
    return rounded(fire.current_state(adapters.located(spark, sf_dir), F.lit("2024-01-15 12:00:00").cast("timestamp")), "mean_bright", "age_h")


@query(
    f"""with times as ({D_TIMES}), d as (select product, x, y, latitude, longitude, acquired_at, max(bright_ti4) as bright_ti4 from {adapters.located_oracle()} l group by all)
    select snapshot, x, y, count(*) as n, count(distinct product) as platforms, round(avg(bright_ti4), 6) as mean_bright, round((epoch_us(snapshot) - epoch_us(max(acquired_at))) / 3.6e9, 6) as age_h
    from d join times on acquired_at between snapshot - interval 24 hours and snapshot - interval 3 hours group by 1, 2, 3"""
)
def current_cells_half_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of every cell at every 12-hour snapshot. Of repeated detections the brightest counts."""
    return rounded(fire.snapshot_states(adapters.located(spark, sf_dir)), "mean_bright", "age_h")


_TX, _TY = grid.mercator_tile("latitude", "longitude", 50_000.0)


@query(
    f"""with d as (select *, {_TX} as tx, {_TY} as ty, cast(ceil((epoch_us(acquired_at)//1000000 + 10800) / 21600.0) as bigint) as r0, cast(floor((epoch_us(acquired_at)//1000000 + 86400) / 21600.0) as bigint) as r1 from {adapters.oracle('detections')} x),
    t as (select run, tx, ty, count(*) as n, max(bright_ti4) as max_bright, max(epoch_us(acquired_at)//1000000) as latest, max_by(detection_id, row(bright_ti4, detection_id)) as representative from d, range(r0, r1 + 1) g(run) group by 1, 2, 3),
    s as (select *, (run * 21600 - latest) / 3600e0 as age_h from t), z as (select *, {grid.evidence_score('max_bright', 'n', 'age_h', rounding='round_even')} as score from s),
    k as (select *, row_number() over (partition by run order by score desc, tx, ty) as place from z)
    select run, tx, ty, n, round(max_bright, 6) as max_bright, representative, round(age_h, 6) as age_h, score, place, case when place > 32 then 'per-run-tile-cap' else 'selected' end as reason from k"""
)
def forecast_tile_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked tiles of every model run; those beyond the plan's size are marked."""
    return rounded(fire.tile_buckets(adapters.derived(spark, sf_dir, "detections")), "max_bright", "age_h")


@query(f"select expected_coverage_id, arg_max(status, row(recorded_at, append_order)) as status, max(recorded_at) as recorded_at, arg_max(append_order, row(recorded_at, append_order)) as append_order from {adapters.oracle('ledger')} l group by 1")
def ledger_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.latest_by(adapters.derived(spark, sf_dir, "ledger"), ["expected_coverage_id"], ["recorded_at", "append_order"])


@query(
    f"""with l as (select * from {adapters.oracle('ledger')} q), s as (select expected_coverage_id, arg_max(status, row(recorded_at, append_order)) as status from l group by 1),
    e as (select concat('firms:P', p, ':', cast(cast(d as date) as varchar)) as expected_coverage_id, cast(d as date) as day from (select min(recorded_at) a, max(recorded_at) b from l) m, generate_series(a, b, interval 1 day) g(d), range(0, 3) h(p))
    select expected_coverage_id, day from e anti join (select * from s where status in ('complete', 'empty-confirmed')) t using (expected_coverage_id)"""
)
def ledger_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of each product that still need collection."""
    entries = adapters.derived(spark, sf_dir, "ledger")
    ends = entries.agg(F.min("recorded_at").alias("a"), F.max("recorded_at").alias("b"))
    days = ends.where("a is not null").select(F.explode(F.expr("sequence(to_date(a), to_date(b))")).alias("day"))
    expected = days.select("day", F.explode(F.array(*map(F.lit, range(3)))).alias("p")).select(F.concat(F.lit("firms:P"), F.col("p"), F.lit(":"), F.col("day").cast("string")).alias("expected_coverage_id"), "day")
    return ledger.coverage_gaps(expected, entries)


@query(
    f"""select cast(date_trunc('month', recorded_at) as date) as month, case when bool_or(status = 'failed') then 'failed' when bool_or(status = 'partial') then 'partial' when bool_and(status = 'empty-confirmed') then 'empty-confirmed' else 'complete' end as status, count(*) as n
    from {adapters.oracle('ledger')} l group by 1"""
)
def ledger_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = adapters.derived(spark, sf_dir, "ledger").withColumn("month", F.to_date(F.date_trunc("month", "recorded_at")))
    return entries.groupBy("month").agg(ledger.range_status(), F.count("*").alias("n")).toDF("month", "status", "n")


_RUNS = "select source_grid_id, variable, {t} as value, seq, {r} as run_at, {a} as availability_at, {v} as valid_at from "
_D_RUNS = _RUNS.format(t="value", r="run_day + to_hours(run_hour)", a="run_day + to_minutes(avail_minute)", v="run_day + to_hours(valid_hour)")


@query(
    f"""with f as ({_D_RUNS} {adapters.oracle('forecasts')} q), m as (select g.t as anchor_at, f.* from (select min(run_at) a, max(valid_at) b from f) e, generate_series(date_trunc('day', a), b, interval 7 days) g(t) join f on run_at <= availability_at and availability_at <= g.t and g.t < valid_at)
    select anchor_at, source_grid_id, variable, arg_max(value, row(availability_at, seq)) as value, arg_max(seq, row(availability_at, seq)) as seq, max(availability_at) as availability_at from m group by 1, 2, 3"""
)
def forecasts_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forecasts known at one cutoff a week, per grid point and variable."""
    return _forecasts_at(spark, sf_dir, "interval 7 days")


@query(_SQL["forecasts_known"].replace("interval 7 days", "interval 12 hours"))
def forecasts_known_half_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forecasts known at every 12-hour cutoff, per grid point and variable."""
    return _forecasts_at(spark, sf_dir, "interval 12 hours")


def _forecasts_at(spark: SparkSession, sf_dir: str, step: str) -> DataFrame:
    f = adapters.derived(spark, sf_dir, "forecasts").selectExpr(
        "source_grid_id", "variable", "value", "seq", "run_day + make_interval(0, 0, 0, 0, run_hour) as run_at",
        "run_day + make_interval(0, 0, 0, 0, 0, avail_minute) as availability_at", "run_day + make_interval(0, 0, 0, 0, valid_hour) as valid_at",
    )
    ends = f.agg(F.date_trunc("day", F.min("run_at")).alias("a"), F.max("valid_at").alias("b"))
    anchors = ends.where("a is not null").select(F.explode(F.expr(f"sequence(a, b, {step})")).alias("anchor_at"))
    return ledger.forecasts_as_of(f, anchors, ["source_grid_id", "variable"]).select("anchor_at", "source_grid_id", "variable", "value", "seq", "availability_at")


D_BINS = f"select distinct fire_id, time_bucket(interval 12 hours, acquired_at, timestamp '2024-01-01') as t from {adapters.oracle('detections')} d"


@query(
    f"""with b as ({D_BINS}), n as (select *, case when t - lag(t) over w = interval 12 hours then 0 else 1 end as fresh from b window w as (partition by fire_id order by t)),
    s as (select fire_id, t, cast(sum(fresh) over (partition by fire_id order by t) as bigint) as sequence from n) select *, row_number() over (partition by fire_id, sequence order by t) as place from s"""
)
def activity_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of half-days without a gap, per fire."""
    d = adapters.derived(spark, sf_dir, "detections").select("fire_id", F.window("acquired_at", "12 hours").start.alias("t"))
    return ledger.gap_sequences(d, ["fire_id"], "t")


@query(f"with b as (select t, count(*) as n from (select time_bucket(interval 12 hours, acquired_at, timestamp '2024-01-01') as t from {adapters.oracle('detections')} d) group by 1), k as (select *, row_number() over (order by t) as k, count(*) over () as c from b) select t, n, case when k <= greatest(1, floor(c * 8e-1)) then 'train' else 'validation' end as dataset_split from k")
def chronological_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = adapters.derived(spark, sf_dir, "detections").select(F.window("acquired_at", "12 hours").start.alias("t"))
    return ledger.chronological_split(d.groupBy("t").agg(F.count("*").alias("n")), "t")


S = adapters.oracle("scores")


@query(f"with b as (select split_no, cast(least(floor(p * 10), 9) as int) as bin, count(*) as n, avg(p) as m, avg(y) as r from {S} s group by 1, 2) select s.split_no, cast(g.bin as int) as bin, coalesce(n, 0) as n, round(m, 6) as mean_p, round(r, 6) as rate, round(abs(m - r), 6) as gap from (select distinct split_no from {S} q) s cross join range(0, 10) g(bin) left join b on b.split_no = s.split_no and b.bin = g.bin")
def score_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.calibration_bins(adapters.derived(spark, sf_dir, "scores"), ["split_no"]), "mean_p", "rate", "gap")


@query(
    f"""with c as (select split_no, p, sum(y) as pos, count(*) as n, sum((y - p) * (y - p)) as sq from {S} s group by 1, 2),
    r as (select *, sum(pos) over w as tp, sum(n) over w as seen, sum(pos) over (partition by split_no) as ap, sum(n) over (partition by split_no) as an from c window w as (partition by split_no order by p desc))
    select split_no, round(sum(sq) / sum(n), 6) as brier, round(sum(pos * ((an - ap) - (seen - tp) + 0.5e0 * (n - pos))) / max(ap * (an - ap)), 6) as roc_auc, round(sum(pos / ap * tp / seen), 6) as average_precision, cast(sum(n) as bigint) as n from r group by 1"""
)
def score_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.ranking_metrics(adapters.derived(spark, sf_dir, "scores"), ["split_no"]), "brier", "roc_auc", "average_precision")


@query(
    f"""with c as (select split_no, step, count(*) filter (p >= 5e-1 and y = 1) as tp, count(*) filter (p >= 5e-1 and y = 0) as fp, count(*) filter (p < 5e-1 and y = 1) as fn, count(*) filter (p < 5e-1 and y = 0) as tn from {S} s group by 1, 2)
    select *, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1 from c"""
)
def score_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.confusion(adapters.derived(spark, sf_dir, "scores"), ["split_no", "step"]), "precision", "recall", "f1")


_SUMMARY = "select {k}, count(*) as n, count(*) filter (bright_ti4 is null) as missing, round(min(bright_ti4), 6) as least, round(avg(bright_ti4), 6) as mean, round(max(bright_ti4), 6) as most, round(stddev_pop(bright_ti4), 6) as deviation, round(quantile_cont(bright_ti4, 25e-2), 6) as q25, round(quantile_cont(bright_ti4, 5e-1), 6) as q50, round(quantile_cont(bright_ti4, 75e-2), 6) as q75 from {t} d group by 1"


@query(_SUMMARY.format(k="product", t=adapters.oracle("detections")))
def brightness_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = evaluate.feature_summary(adapters.derived(spark, sf_dir, "detections"), ["product"], "bright_ti4")
    return rounded(out, "least", "mean", "most", "deviation", "q25", "q50", "q75")


_DRIFT = "select product, count(*) n, count(*) filter (bright_ti4 is null) missing, avg(bright_ti4) mean, stddev_pop(bright_ti4) deviation, quantile_cont(bright_ti4, 25e-2) q25, quantile_cont(bright_ti4, 5e-1) q50, quantile_cont(bright_ti4, 75e-2) q75 from {t} d where region = '{r}' group by 1"


@query(
    f"""with a as ({_DRIFT.format(t=adapters.oracle('detections'), r='CONUS')}), b as ({_DRIFT.format(t=adapters.oracle('detections'), r='Canada')}), j as (select a.product, abs(a.missing / a.n - b.missing / b.n) as g,
    greatest(abs(a.mean - b.mean), abs(a.q25 - b.q25), abs(a.q50 - b.q50), abs(a.q75 - b.q75)) / greatest(a.deviation, 1e-12) as s from a join b using (product)) select product, round(g, 6) as missing_gap, round(s, 6) as shift, g <= 1e-1 and s <= 5e-1 as passes from j"""
)
def brightness_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = adapters.derived(spark, sf_dir, "detections")
    a, b = (evaluate.feature_summary(d.where(F.col("region") == r), ["product"], "bright_ti4") for r in ("CONUS", "Canada"))
    return rounded(evaluate.drift_screen(a, b, ["product"]), "missing_gap", "shift")


@query(
    f"""with d as (select *, lag(elevation_m) over x as w, lead(elevation_m) over x as e, lag(elevation_m) over z as n, lead(elevation_m) over z as s from {adapters.oracle('raster')} q window x as (partition by r order by c), z as (partition by c order by r)),
    g as (select r, c, elevation_m, (coalesce(e, elevation_m) - coalesce(w, elevation_m)) / (3e1 * greatest(1, (w is not null)::int + (e is not null)::int)) as gx, (coalesce(s, elevation_m) - coalesce(n, elevation_m)) / (3e1 * greatest(1, (n is not null)::int + (s is not null)::int)) as gy from d)
    select r, c, elevation_m, round(degrees(atan(sqrt(gx * gx + gy * gy))), 6) as slope_deg from g"""
)
def terrain_slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.slope(adapters.derived(spark, sf_dir, "raster")), "slope_deg")


@query("")
def incident_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fires whose footprints (boxes of their cells) lie within 20 km, as connected groups."""
    d = adapters.located(spark, sf_dir).groupBy("fire_id").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    boxes = cut(d, "incident-boxes")
    links = spatial.near_boxes(boxes, "fire_id", 20.0).withColumnRenamed("other", "o_fire_id")
    loops = boxes.select("fire_id", F.col("fire_id").alias("o_fire_id"))
    return connected_components(links.unionByName(loops), "fire_id", "o_fire_id").select(F.col("node").alias("fire_id"), F.col("component").alias("group_id"))


_REDACT = r"(?i)(key|token|secret)=[^&\s]+"


@query(f"select page_id, regexp_replace(url, '{_REDACT}', '\\1=REDACTED', 'g') as url from pages")
def redacted_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", _REDACT, "$1=REDACTED").alias("url"))


def queries() -> dict[str, Query]:
    from cinderspan.plans import admitted, associations, measures, models, readers, records, rows, transitions  # noqa: F401  (they add their queries)

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)
