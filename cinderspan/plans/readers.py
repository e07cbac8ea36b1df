"""Queries of captured pages, storage categories, frontier rows and incident sequences, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspan.functions import grid
from cinderspan.operators import frontier, ledger, records
from cinderspan.operators.evaluate import intensity
from cinderspan.plans.catalog import D_BINS, query, rounded
from cinderspan.plans.records import FEATURES, duck, made
from cinderspan.plans.transitions import D_FRONTIER, D_STATE, _frontier
from cinderspan.session import shared_path, table
from cinderspan.sources import adapters, features


def _paged(spark: SparkSession, rows: DataFrame, item, outer: dict[str, object], name: str) -> str:
    """Write rows as pages of at most a hundred items, one JSON text a line."""
    pages = rows.groupBy(F.floor(F.col("event_id") / 100)).agg(F.collect_list(item).alias("items"))
    path = shared_path(spark, name)
    keys = {k: (F.col("items") if v is None else F.lit(v)) for k, v in outer.items()}
    pages.select(F.to_json(F.struct(*(c.alias(k) for k, c in keys.items()))).alias("value")).write.text(path)
    return path


@query(
    f"""select event_id, coalesce(primarykey, concat_ws('|', region, fireid, strftime(source_snapshot_time, '%Y-%m-%dT%H:%M:%SZ'))) as source_record_id, region, source_snapshot_time, 1 as n_rings, event_id % 90 + 5e-1 as first_lon
    from (select *, coalesce(strptime(split_part(primarykey, '|', 3), '%Y-%m-%dT%H:%M:%S'), make_timestamp(t * 1000)) as source_snapshot_time from {duck(FEATURES)} f) q"""
)
def perimeter_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygon features read from captured pages and normalized."""
    rows = made(spark, sf_dir, FEATURES, "events")
    ring = F.expr("array(array(array(event_id % 90 + 0.5D, 50D), array(event_id % 90 + 1.5D, 50D), array(event_id % 90 + 1.5D, 51D)))")
    item = F.struct(F.struct("event_id", "primarykey", "region", "fireid", "t", "n_newpixels").alias("attributes"), F.struct(ring.alias("rings")).alias("geometry"))
    path = _paged(spark, rows, item, {"features": None}, "perimeter-pages")
    found = records.normalize_perimeters(features.read_perimeter_pages(spark, path, f"event_id long, {features.ATTRIBUTES}"))
    return found.select("event_id", "source_record_id", "region", "source_snapshot_time", F.size("rings").alias("n_rings"), F.expr("rings[0][0][0]").alias("first_lon"))


def _geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "cast(ts as timestamp) as s", "cast(ts as timestamp) + make_interval(0, 0, 0, 0, 6 * (event_id % 9) + 1) as e", "case event_id % 3 when 0 then null when 1 then '' else concat('N', user_id) end as nat"
    )
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    fields = F.struct("event_id", F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("id"), F.col("nat").alias("national_fire_id"), stamp("s").alias("record_start"), stamp("e").alias("record_end"))
    shape = F.struct(F.lit("Point").alias("type"), F.expr("array(-100, user_id % 60)").alias("coordinates"))
    path = _paged(spark, rows, F.struct(fields.alias("properties"), shape.alias("geometry")), {"type": "FeatureCollection", "features": None}, "geojson-pages")
    return features.read_geojson(spark, path)


@query("select event_id, 'final_reference' as label_tier, 0.55e0 as label_quality_score, 'Point' as shape, concat('[-100,', cast(user_id % 60 as varchar), ']') as coordinates, concat('r', cast(event_id as varchar)) as id from events")
def reference_perimeters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference records of GeoJSON features."""
    found = features.reference_perimeters(_geojson(spark, sf_dir))
    field = lambda c: F.col("source_fields")[c]
    return found.select(field("event_id").cast("bigint").alias("event_id"), "label_tier", "label_quality_score", F.col("geometry.type").alias("shape"), F.col("geometry.coordinates").alias("coordinates"), field("id").alias("id"))


@query(
    """with q as (select event_id, user_id, date_trunc('second', cast(ts as timestamp)) as record_start, date_trunc('second', cast(ts as timestamp) + (6 * (event_id % 9) + 1) * interval 1 hour) as record_end from events),
    e as (select cast(min(record_start) as date) + 2 as a, cast(max(record_start) as date) - 2 as b from q)
    select event_id, case when event_id % 3 = 2 then concat('N', cast(user_id as varchar)) else concat('r', cast(event_id as varchar)) end as incident_id, record_start, record_end,
      record_end > timestamp '2024-01-05' and record_start < timestamp '2024-01-21' as in_dates, record_end > a and record_start <= b as in_extent from q, e"""
)
def incident_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incident intervals of GeoJSON features, and whether they meet given dates and the extent of the table."""
    found = features.incident_history(_geojson(spark, sf_dir)).withColumn("event_id", F.col("source_fields")["event_id"].cast("bigint"))
    first = F.date_trunc("day", F.min(F.date_trunc("second", F.col("ts").cast("timestamp"))))
    last = F.date_trunc("day", F.max(F.date_trunc("second", F.col("ts").cast("timestamp"))))
    extent = table(spark, sf_dir, "events").agg((first + F.expr("interval 2 days")).alias("a"), (last - F.expr("interval 2 days")).alias("b"))
    met = found.crossJoin(F.broadcast(extent))  # one row
    tests = features.intersects_dates("record_start", "record_end", "2024-01-05", "2024-01-20"), features.intersects_extent("record_start", "record_end", "a", "b")
    return met.select("event_id", "incident_id", "record_start", "record_end", tests[0].alias("in_dates"), tests[1].alias("in_extent"))


_DAY_OF = "cast(ts as date)"
_STATUS = "case when event_id % 97 = 0 then 'failed' else 'complete' end"


def _granules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").selectExpr("event_id", "date_trunc('second', cast(ts as timestamp)) as s", "event_id % 3 as k")
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    unit = F.element_at(F.array(F.lit("KB"), F.lit("MB"), F.lit("gb")), (F.col("k") + 1).cast("int"))
    url = lambda start, end, kind: F.struct(F.concat(F.lit(start), F.col("event_id").cast("string"), F.lit(end)).alias("URL"), F.lit(kind).alias("Type"))
    urls = F.array(url("s3://a/", ".nc", "GET DATA"), url("https://a/", ".html", "GET DATA"), url("https://a/", ".nc", "GET DATA"), url("https://b/", ".nc", "GET DATA"))
    check = F.when(F.col("k") == 1, F.struct(F.md5(F.col("event_id").cast("string")).alias("Value"), F.lit("MD5").alias("Algorithm")))
    info = F.array(F.struct((F.col("event_id") % 500 + 0.25).alias("Size"), unit.alias("SizeUnit"), check.alias("Checksum")))
    span = F.struct(stamp("s").alias("BeginningDateTime"), stamp(F.col("s") + F.expr("interval 6 minutes")).alias("EndingDateTime"))
    umm = F.struct(
        F.concat(F.lit("G"), F.col("event_id").cast("string")).alias("GranuleUR"), F.struct(F.lit("P14").alias("ShortName"), F.lit("2").alias("Version")).alias("CollectionReference"),
        F.struct(span.alias("RangeDateTime")).alias("TemporalExtent"), urls.alias("RelatedUrls"), F.struct(info.alias("ArchiveAndDistributionInformation")).alias("DataGranule"),
    )
    return features.read_granules(spark, _paged(spark, rows, F.struct(umm.alias("umm")), {"items": None}, "granule-pages"), "P14", "2")


@query(
    """select concat('G', cast(event_id as varchar)) as granule_id, date_trunc('second', cast(ts as timestamp)) as begins_at, date_trunc('second', cast(ts as timestamp)) + interval 6 minutes as ends_at, concat('https://a/', cast(event_id as varchar), '.nc') as download_url,
    cast((event_id % 500 + 25e-2) * case event_id % 3 when 0 then 1000 when 1 then 1000000 else 1000000000 end as bigint) as bytes, case when event_id % 3 = 1 then md5(cast(event_id as varchar)) end as checksum, case when event_id % 3 = 1 then 'MD5' end as checksum_algorithm from events"""
)
def granule_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Granules of captured inventory pages."""
    return _granules(spark, sf_dir).drop("raw_file")


@query(
    f"""with g as (select event_type as product, {_DAY_OF} as day, {_STATUS} as status from events), e as (select min(day) as a, max(day) as b from g),
    d as (select product, cast(t as date) as day from (select distinct product from g) p, e, generate_series(cast(a as timestamp), cast(b as timestamp) + interval 3 days, interval 1 day) s(t)),
    n as (select d.product, d.day, count(g.status) as n_granules, count(*) filter (g.status = 'complete') as n_complete from d left join g using (product, day) group by 1, 2)
    select n.*, case when n_granules > 0 then case when n_complete = n_granules then 'complete' else 'partial' end when cast(b as timestamp) + interval 72 hours >= cast(day as timestamp) + interval 48 hours then 'empty' else 'pending' end as status from n, e"""
)
def granule_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of every product's days, three beyond the last one; it is three days after the last one's start."""
    g = table(spark, sf_dir, "events").selectExpr("event_type as product", f"{_DAY_OF} as day", f"{_STATUS} as status")
    days = g.groupBy().agg(F.min("day").alias("a"), F.max("day").alias("b"), F.collect_set("product").alias("products"))
    # The time that counts as now goes with the days, so nothing is fetched to the driver.
    due = days.select(F.explode("products").alias("product"), "a", "b").select("product", F.explode(F.expr("sequence(a, date_add(b, 3))")).alias("day"), F.expr("cast(b as timestamp) + interval 72 hours").alias("now"))
    return features.granule_days(due, g, F.col("now")).drop("now")


_STARTS = ["raw/nasa-firms/", "l2/a/", "raw/cwfis-2024/", "weather/", "static/x/", "staging/", "normalized/", "normalized/historical-weather/", "other/raw/nasa-firms/"]
_NAMES = ["firms_and_detection_evidence", "viirs_l2_paired_cutouts", "operational_labels_and_progression", "issued_weather_tiles", "static_cell_features", "manifests_staging_and_headroom", "derived_training_views", "issued_weather_tiles", "unallocated"]


@query(f"select c.category, count(*) as n_files, cast(sum(o_orderkey) as bigint) as bytes from orders, (select unnest(range({len(_NAMES)})) as k, unnest({_NAMES!r}) as category) c where o_orderkey % {len(_NAMES)} = k group by 1")
def path_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and bytes by the storage category of their paths."""
    starts = "array(" + ", ".join(f"'{s}'" for s in _STARTS) + ")"
    files = table(spark, sf_dir, "orders").selectExpr(f"concat('/', {starts}[cast(o_orderkey % {len(_STARTS)} as int)], o_orderkey, '.gz') as path", "o_orderkey as size")
    return files.groupBy(features.storage_category("path").alias("category")).agg(F.count("*").alias("n_files"), F.sum("size").alias("bytes"))


@query("select event_id, 0 as firms_center_has_detection, value from events where value < 5e1")
def frontier_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose centre has no detection."""
    return frontier.frontier_rows(table(spark, sf_dir, "events").selectExpr("event_id", "cast(value >= 50 as int) as firms_center_has_detection", "value").where("value is not null"))


@query(f"with s as ({D_STATE}) select scenario, x, y, round(intensity, 6) as intensity from s")
def seeds_from_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per day and cell the strongest detection as a seed."""
    points = adapters.located(spark, sf_dir).select(F.to_date("acquired_at").alias("scenario"), "x", "y", intensity("bright_ti4").alias("intensity"))
    return rounded(frontier.seeds_from_points(points), "intensity")


@query(
    f"with {D_FRONTIER} select scenario, x, y, round(neighbour_intensity, 6) as neighbour_intensity, place from (select *, row_number() over (partition by scenario order by neighbour_intensity desc, {grid.cell_id('x', 'y')}) as place from front) p where place <= 1500"
)
def frontier_strongest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidates with the strongest neighbours, within a cap per scenario."""
    return rounded(frontier.strongest_candidates(_frontier(spark, sf_dir)[1], most=1500).select("scenario", "x", "y", "neighbour_intensity", "place"), "neighbour_intensity")


@query(
    f"""with b as (select fire_id, t from ({D_BINS}) q where t < timestamp '2024-01-25'), i as (select *, lag(t) over (partition by fire_id order by t) as before from b),
    n as (select fire_id, t, sum(case when before = t - interval 12 hours then 0 else 1 end) over (partition by fire_id order by t) as sequence from i)
    select fire_id, t, cast(sequence as bigint) as sequence, row_number() over (partition by fire_id, sequence order by t) as place from n"""
)
def incident_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-days of every fire before a date, in runs without a gap."""
    d = adapters.derived(spark, sf_dir, "detections").select("fire_id", F.window("acquired_at", "12 hours").start.alias("t"))
    return ledger.regular_sequences(d, ["fire_id"], "t", until="2024-01-25")
