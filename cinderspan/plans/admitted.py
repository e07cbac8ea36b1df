"""Queries of origins, captures, mixed and unscored views, terrain of frontiers, boxes and bounds, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspan.functions import grid
from cinderspan.operators import fire, frontier, incidents, ledger, views
from cinderspan.plans.catalog import _SQL, D_BINS, D_TIMES, _positives, query
from cinderspan.plans.measures import frontier_features
from cinderspan.plans.records import duck, made
from cinderspan.session import cut, shared_path
from cinderspan.sources import adapters


@query(
    f"""with b as ({D_BINS}), s as (select *, case when dense_rank() over (order by t) <= greatest(1, floor((select count(distinct t) from b) * 8e-1)) then 'train' else 'validation' end as dataset_split from b),
    seeds as (select distinct b.fire_id, b.t from b join {adapters.oracle('detections')} d on d.fire_id = b.fire_id and d.acquired_at between b.t - interval 24 hours and b.t - interval 3 hours),
    i as (select *, t - row_number() over (partition by fire_id, dataset_split order by t) * interval 12 hours as island from s),
    left_ as (select fire_id, dataset_split, t, count(*) over (partition by fire_id, dataset_split, island order by t rows between current row and unbounded following) as n_times from i)
    select fire_id, dataset_split, min(t) as origin, arg_min(n_times, t) as n_times from left_ semi join seeds using (fire_id, t) where n_times >= 3 group by 1, 2"""
)
def split_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per fire and split the first half-day that has evidence before it and begins three steps wholly in the split."""
    d = adapters.derived(spark, sf_dir, "detections")
    times = ledger.chronological_split(d.select("fire_id", F.window("acquired_at", "12 hours").start.alias("t")).distinct(), "t")
    # A detection is evidence for the two half-days at most whose gate holds it.
    seeds = d.withColumn("w", F.window("acquired_at", "12 hours").start).select("fire_id", F.explode(F.expr("filter(sequence(w, acquired_at + interval 24 hours, interval 12 hours), t -> acquired_at between t - interval 24 hours and t - interval 3 hours)")).alias("t"))
    return incidents.first_origins(times, ["fire_id"], "t", "dataset_split", seeds, 3)


MANIFESTS = "select cast(date_trunc('month', o_orderdate) as timestamp) as captured_at, sha2_hex as content_sha256, manifest_path from (select o_orderdate, {h} as sha2_hex, concat('raw/', cast(o_orderkey as {S}), '.json') as manifest_path from orders)"


@query(f"select captured_at, content_sha256, min(manifest_path) as manifest_path from {duck(MANIFESTS.format(h='sha256(cast(o_custkey % 50 as varchar))', S='varchar'))} m where captured_at = timestamp '1996-03-01' group by 1, 2")
def capture_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contents of one named capture, each with the first manifest that has it."""
    from cinderspan.plans.measures import CAPTURES

    chosen = views.select_capture(made(spark, sf_dir, CAPTURES, "orders"), captured_at="1996-03-01")
    manifests = made(spark, sf_dir, MANIFESTS.format(h="sha2(cast(o_custkey % 50 as string), 256)", S="string"), "orders")
    return views.capture_artifacts(manifests, chosen).select("captured_at", "content_sha256", "manifest_path")


MIXED = """select detection_id as example_id, fire_id as incident_group_id, case when fire_id % 5 = 0 then 'held_incident' else 'train' end as incident_split,
  case when event_type = 'purchase' then 1 else 0 end as firms_center_has_detection, bright_ti4 as local_max, acquired_at from {d} d"""


@query(
    f"""with e as ({MIXED.format(d=adapters.oracle('detections'))}), o as (select * from e where incident_split = 'train' and firms_center_has_detection = 0)
    select *, cast(1 as double) as sample_weight, null as original_example_id from o
    union all select concat('s:', example_id), incident_group_id, incident_split, firms_center_has_detection, local_max * 9e-1, null, 5e-1, example_id from o where incident_group_id % 4 = 1"""
)
def mixed_view_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed references and synthetic rows, published, read back by their manifests, checked and united."""
    examples = spark.sql(MIXED, d=adapters.derived(spark, sf_dir, "detections"))
    own = examples.where("incident_split = 'train' and firms_center_has_detection = 0")
    references = own.select("example_id", "incident_group_id", "incident_split", F.lit(1.0).alias("sample_weight"))
    synthetic = own.where("incident_group_id % 4 = 1").selectExpr(
        "concat('s:', example_id) as example_id", "incident_group_id", "incident_split", "firms_center_has_detection", "local_max * 9e-1 as local_max", "5e-1 as sample_weight", "example_id as original_example_id"
    )
    folder, manifests = shared_path(spark, "mixed"), shared_path(spark, "manifests")
    for kind, part in (("mixed-observed", references), ("mixed-synthetic", synthetic)):
        views.publish(spark, part, folder, "b1", kind, "v1", ["incident_split"], manifests)
    known = spark.read.parquet(manifests)
    observed, made_rows = (views.read_view(spark, known, kind, "v1", "example_id") for kind in ("mixed-observed", "mixed-synthetic"))
    return views.mixed_view(observed, made_rows, examples, 0.5, 0.5)


@query(_SQL["positives_unscored"])
def unscored_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positives that no candidate covers, published as a view of their own kind and read by its manifest."""
    located = adapters.located(spark, sf_dir)
    rows = fire.unscored_positives(fire.expand_candidates(located), _positives(spark, sf_dir))
    keyed = rows.withColumn("row_id", F.concat_ws("|", F.date_format("snapshot", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.expr(grid.cell_id("x", "y")))).withColumn("day", F.to_date("snapshot"))
    folder, manifests = shared_path(spark, "unscored"), shared_path(spark, "manifests")
    views.publish(spark, keyed, folder, "b1", "unscored", "v1", ["day"], manifests)
    return views.read_view(spark, spark.read.parquet(manifests), "unscored", "v1", "row_id").select(*rows.columns)


GROUND = """select x, y, abs(x + y) % 4 <> 0 as terrain_valid, case when abs(x + y) % 4 = 0 then cast(null as double) else abs(x * 3 + y) % 3000 / 1e0 end as terrain_elevation_m, abs(x * 7 + y) % 300 / 1e1 as terrain_slope_degrees,
  abs(y) % 3 <> 0 as terrain_aspect_defined, (abs(x) % 21 - 10) / 1e1 as terrain_aspect_sin, (abs(y) % 21 - 10) / 1e1 as terrain_aspect_cos from (select distinct x + 1 as x, y from {l} l)"""


@query(
    f"""with g as ({GROUND.format(l=adapters.located_oracle())}), f as ({_SQL['frontier_features']})
    select f.*, cast(coalesce(terrain_valid, false) as double) as terrain_valid, case when terrain_valid then terrain_elevation_m end as terrain_elevation_m, case when terrain_valid then terrain_slope_degrees end as terrain_slope_degrees,
      cast(coalesce(terrain_valid and terrain_aspect_defined, false) as double) as terrain_aspect_defined, case when terrain_valid then terrain_aspect_sin end as terrain_aspect_sin, case when terrain_valid then terrain_aspect_cos end as terrain_aspect_cos
    from f left join g using (x, y)"""
)
def frontier_terrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered features of every frontier cell with its terrain, where that is known and valid."""
    # Written, as terrain is a table of its own; the projection's long expressions then stand in no join's filter.
    cells = cut(adapters.located(spark, sf_dir).select("x", "y").distinct(), "ground")
    return frontier.with_terrain(frontier_features(spark, sf_dir), spark.sql(GROUND, l=cells))


BOX = (-115.0, 40.0, -85.0, 55.0)


@query(
    f"""with times as ({D_TIMES}), d as (select distinct product, latitude, longitude, acquired_at, x, y from {adapters.located_oracle()} l where longitude between {BOX[0]} and {BOX[2]} and latitude between {BOX[1]} and {BOX[3]}),
    m as (select snapshot, x, y, acquired_at <= snapshot - interval 3 hours as old from d join times on acquired_at between snapshot - interval 24 hours and snapshot)
    select snapshot, count(*) filter (old) as eligible_detection_count, count(*) filter (not old) as recent_detections_excluded, count(distinct row(x, y)) filter (old) as active_cell_count from m group by 1"""
)
def snapshot_box_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a box shows at every 12-hour snapshot: detections that count, younger ones, active cells."""
    return fire.snapshot_reports(adapters.located(spark, sf_dir), BOX)


@query(f"select distinct x, y, x * 1e3 as x_min, y * 1e3 as y_min, (x + 1) * 1e3 as x_max, (y + 1) * 1e3 as y_max from {adapters.located_oracle()} l")
def cell_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projected sides of every cell that has a detection."""
    sides = [F.expr(e).alias(n) for e, n in zip(grid.cell_bounds("x", "y"), ("x_min", "y_min", "x_max", "y_max"))]
    return adapters.located(spark, sf_dir).select("x", "y").distinct().select("x", "y", *sides)
