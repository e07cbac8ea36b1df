"""Queries of normalized records, their checks, labels and terrain, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspan.functions import grid
from cinderspan.operators import labels, ledger, records, terrain
from cinderspan.plans.catalog import query, rounded
from cinderspan.session import cut, shared_path, table
from cinderspan.sources import adapters


def made(spark: SparkSession, sf_dir: str, sql: str, source: str) -> DataFrame:
    """A table that SQL of both engines derives from a given one."""
    return spark.sql(sql.replace("{S}", "string").replace(f"from {source}", "from {t}"), t=table(spark, sf_dir, source))


def duck(sql: str) -> str:
    return "(" + sql.replace("{S}", "varchar") + ")"


# Raw detections as text: decimals put together from whole numbers, so that both engines write them alike.
RAW = """select event_id, concat(cast(35 + cast(floor((user_id*17 % 250) / 1e1) as int) as {S}), '.', cast(user_id*17 % 10 as {S})) as latitude,
  concat('-', cast(cast(floor((1200 - user_id*29 % 500) / 1e1) as int) as {S}), '.', cast((1200 - user_id*29 % 500) % 10 as {S})) as longitude,
  concat(cast(290 + user_id % 60 as {S}), '.', cast(event_id % 10 as {S})) as bright_ti4, cast(cast(ts as date) as {S}) as acq_date,
  cast(hour(cast(ts as timestamp)) * 100 + minute(cast(ts as timestamp)) as {S}) as acq_time,
  case event_id % 3 when 0 then ' N20 ' when 1 then '  ' else 'n21' end as satellite from events"""
_FIELDS = ["acq_date", "acq_time", "bright_ti4", "event_id", "latitude", "longitude", "satellite"]
_D_JSON = "concat('{\"raw_source_fields\":{', " + ", ',', ".join(f"""'"{f}":"', cast({f} as varchar), '"'""" for f in _FIELDS) + ", '},\"source_id\":\"', source_id, '\"}')"


@query(
    f"""with s as (select *, concat('firms-source:', sha256('{{"product":"VIIRS","provider":"NASA"}}')) as source_id from {duck(RAW)} r)
    select event_id, source_id, concat('firms-detection:', sha256({_D_JSON})) as detection_id, strptime(concat(acq_date, ' ', lpad(acq_time, 4, '0')), '%Y-%m-%d %H%M') as acquired_at,
      cast(latitude as double) as latitude, cast(longitude as double) as longitude, cast(bright_ti4 as double) as bright_ti4, cast(bright_ti4 as double) >= 305 as passes,
      case event_id % 3 when 0 then 'n20' when 1 then 'viirs' else 'n21' end as platform from s"""
)
def normalize_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections read from CSV as text, typed and named by what they hold."""
    path = shared_path(spark, "detections-csv")
    made(spark, sf_dir, RAW, "events").write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    found = records.normalize_detections(records.read_detections_csv(spark, path), "NASA", F.lit("VIIRS"))
    platform = records.platform_identity(F.col("raw_source_fields.satellite"), F.col("product"))
    return found.select(F.col("raw_source_fields.event_id").cast("bigint").alias("event_id"), "source_id", "detection_id", "acquired_at", "latitude", "longitude", "bright_ti4", "passes", platform.alias("platform"))


@query(
    f"""select event_id, case when event_id % 10 = 0 then null else x end as x, case when event_id % 10 = 0 then null else y end as y,
    case when event_id % 10 <> 0 then x * 1000 end as west, case when event_id % 10 <> 0 then (y + 1) * 1000 end as north from (select cast(substr(detection_id, 2) as bigint) as event_id, x, y from {adapters.located_oracle()} l) q"""
)
def cell_ids_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of ids and their bounds in metres; ids of tiles have none."""
    d = adapters.located(spark, sf_dir).selectExpr("cast(substr(detection_id, 2) as bigint) as event_id", f"{grid.cell_id('x', 'y')} as cell_id")
    d = d.withColumn("cell_id", F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("webmercator-"), "cell_id")).otherwise(F.col("cell_id")))
    return d.withColumn("c", records.cell_of_id("cell_id")).select("event_id", "c.x", "c.y", F.expr("c.x * 1000").alias("west"), F.expr("(c.y + 1) * 1000").alias("north"))


_D_UTC = "concat(strftime({t}, '%Y-%m-%dT%H:%M:%S'), case when epoch_us({t}) % 1000000 = 0 then '' else concat('.', lpad(cast(epoch_us({t}) % 1000000 as varchar), 6, '0')) end, 'Z')"


@query(
    f"""select detection_id, sha256(concat_ws(chr(31), '1', {grid.cell_id('x', 'y')}, {_D_UTC.format(t='acquired_at')}, '43200')) as example_id, {_D_UTC.format(t='acquired_at')} as anchor_text,
    {_D_UTC.format(t="(acquired_at + interval 12 hours)")} as target_end_text, date_trunc('hour', acquired_at) as weather_hour from {adapters.located_oracle()} l"""
)
def example_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical example ids, their times as text and the weather hour of each."""
    d = adapters.located(spark, sf_dir).withColumn("end_at", F.expr("acquired_at + interval 12 hours"))
    cell = F.expr(grid.cell_id("x", "y"))
    return d.select("detection_id", records.example_id(cell, "acquired_at").alias("example_id"), records.utc_text("acquired_at").alias("anchor_text"), records.utc_text("end_at").alias("target_end_text"), F.date_trunc("hour", "acquired_at").alias("weather_hour"))


@query(
    f"""with p as (select detection_id, radians(latitude) as f, radians(longitude) as l, 6378137e0 as a, 1 - power(1 - 1 / 298.257222101e0, 2) as e2 from {adapters.oracle('detections')} d),
    q as (select *, a / sqrt(1 - e2 * power(sin(f), 2)) as nu from p) select detection_id, round(nu * cos(f) * cos(l), 4) as px, round(nu * cos(f) * sin(l), 4) as py, round(nu * (1 - e2) * sin(f), 4) as pz from q"""
)
def ecef_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earth-centred coordinates of every detection."""
    x, y, z = grid.ecef("latitude", "longitude")
    return rounded(adapters.derived(spark, sf_dir, "detections").selectExpr("detection_id", f"{x} as px", f"{y} as py", f"{z} as pz"), "px", "py", "pz", digits=4)


@query(
    f"""with t as (select detection_id, cast(floor(6378137e0 * radians(longitude) / 96000) as int) as tx, cast(floor(6378137e0 * asinh(tan(radians(latitude))) / 96000) as int) as ty from {adapters.oracle('detections')} d where abs(latitude) < 85)
    select *, round(degrees(tx * 96000 / 6378137e0), 6) as west, round(degrees(atan(sinh(ty * 96000 / 6378137e0))), 6) as south, round(degrees((tx + 5e-1) * 96000 / 6378137e0), 6) as centre_lon, round(degrees(atan(sinh((ty + 5e-1) * 96000 / 6378137e0))), 6) as centre_lat from t"""
)
def mercator_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map tile of every detection within the projection's latitudes, with its corner and centre."""
    tx, ty = grid.mercator_tile("latitude", "longitude", 96_000.0)
    d = adapters.derived(spark, sf_dir, "detections").where("abs(latitude) < 85").selectExpr("detection_id", f"{tx} as tx", f"{ty} as ty")
    west, south = grid.mercator_point("tx", "ty", 96_000.0)
    lon, lat = grid.mercator_point("(tx + 0.5D)", "(ty + 0.5D)", 96_000.0)
    return rounded(d.selectExpr("*", f"{west} as west", f"{south} as south", f"{lon} as centre_lon", f"{lat} as centre_lat"), "west", "south", "centre_lon", "centre_lat")


# Perimeter features: keys with a time (one in seven has none), and a time of their own that often differs.
FEATURES = """select event_id, case when event_id % 7 = 0 then null else concat(case when user_id % 3 = 0 then 'Canada' when user_id % 5 = 0 then 'Alaska' else 'CONUS' end, '|', cast(user_id as {S}), '|', cast(cast(ts as date) as {S}), 'T12:00:00') end as primarykey,
  case when user_id % 3 = 0 then 'Canada' when user_id % 5 = 0 then 'Alaska' else 'CONUS' end as region, user_id as fireid, (event_id % 40) * 43200000 + 1704067200000 as t, cast(floor(value) as int) as n_newpixels from events"""
_D_FEATURES = f"""(select *, coalesce(strptime(split_part(primarykey, '|', 3), '%Y-%m-%dT%H:%M:%S'), make_timestamp(t * 1000)) as source_snapshot_time, make_timestamp(t * 1000) as own from {duck(FEATURES)} f)"""


@query(
    f"""select event_id, coalesce(primarykey, concat_ws('|', region, fireid, strftime(source_snapshot_time, '%Y-%m-%dT%H:%M:%SZ'))) as source_record_id, source_snapshot_time, case when primarykey is null then 'provider-t-fallback' else 'primarykey' end as time_source,
    own = source_snapshot_time as t_matches from {_D_FEATURES} q where region in ('CONUS', 'Canada')"""
)
def perimeters_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perimeter records of the aligned regions: id and time by the key, else by the feature's own time."""
    found = records.eligible_records(records.normalize_perimeters(made(spark, sf_dir, FEATURES, "events")))
    return found.select("event_id", "source_record_id", "source_snapshot_time", "time_source", "t_matches")


@query(
    f"""with r as (select source_snapshot_time, primarykey, count(*) as n, count(distinct n_newpixels) > 1 as differs from {_D_FEATURES} q group by 1, 2)
    select source_snapshot_time, count(*) filter (primarykey is not null) as n_records, cast(sum(case when primarykey is not null and not differs then n - 1 else 0 end) as bigint) as n_duplicates,
      count(*) filter (primarykey is not null and differs) as n_conflicts, cast(sum(case when primarykey is null then n else 0 end) as bigint) as n_invalid from r group by 1"""
)
def perimeter_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per snapshot: records, repeats, conflicts and rows without a key, by a digest that ignores the fetched time."""
    d = records.normalize_perimeters(made(spark, sf_dir, FEATURES, "events"))
    fields = F.create_map(*(x for c in ("region", "fireid", "t", "n_newpixels") for x in (F.lit(c), F.col(c).cast("string"))))
    return records.duplicate_report(d.withColumn("mark", records.fingerprint(fields, ["t", "ESRI_OID"])), "source_snapshot_time", "primarykey", "mark")


# Labels with planted faults: a wrong end, a wrong tier, a missing score.
LABELS = """select event_id, cast(ts as timestamp) as anchor_at, cast(ts as timestamp) + make_interval_{H} as target_end_at, case when event_id % 61 = 0 then 'final' else 'weak_satellite' end as label_tier,
  case when event_id % 73 = 0 then null else value end as score from events"""
_HOURS = "case when event_id % 50 = 0 then 11 else 12 end"


@query(
    """select event_id, unnest(list_filter([case when event_id % 50 = 0 then 'twelve hours' end, case when event_id % 61 = 0 then 'tier' end, case when event_id % 73 = 0 or value is null then 'score' end], lambda r: r is not null)) as rule from events"""
)
def row_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule that a label row breaks."""
    d = made(spark, sf_dir, LABELS.replace("make_interval_{H}", f"make_interval(0, 0, 0, 0, {_HOURS})"), "events")
    rules = {"twelve hours": F.expr("target_end_at = anchor_at + interval 12 hours"), "tier": F.col("label_tier") == "weak_satellite", "score": records.json_safe("score").isNotNull()}
    return records.violations(d, rules, ["event_id"])


_SPLITS = """select event_id, cast(ts as date) as day, case when (cast(ts as date) < date '2024-01-24') = (event_id % 97 <> 0) then 'train' else 'validation' end as dataset_split, user_id from events"""


@query(
    f"""with d as (select day, bool_or(dataset_split = 'train') as t, bool_or(dataset_split = 'validation') as v from {duck(_SPLITS)} s group by 1), f as (select min(day) as first from d where v)
    select day, t and v as mixed, coalesce(t and day >= first, false) as late from d, f where (t and v) or (t and day >= first)"""
)
def split_purity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of two splits, and training days that don't come before validation."""
    return records.split_faults(made(spark, sf_dir, _SPLITS, "events"), "day")


@query(f"select user_id, count(distinct dataset_split) as n_splits, min(dataset_split) as first_split, max(dataset_split) as last_split from {duck(_SPLITS)} s group by 1 having count(distinct dataset_split) > 1")
def group_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups that stand in more than one split."""
    return records.isolation_faults(made(spark, sf_dir, _SPLITS, "events"), "user_id", "dataset_split")


@query(
    """with a as (select o_orderkey as k, count(*) as l from orders where o_orderkey % 9 <> 0 group by 1), b as (select l_orderkey as k, count(*) as r from lineitem where l_linenumber <= 2 and l_orderkey % 7 <> 0 group by 1)
    select case when l is null then 'right-only' when r is null then 'left-only' when l > 1 or r > 1 then 'repeated' else 'matched' end as status, count(*) as n_keys from a full join b using (k) group by 1"""
)
def merge_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the keys of two tables meet that should merge one to one."""
    a = table(spark, sf_dir, "orders").where("o_orderkey % 9 <> 0").select(F.col("o_orderkey").alias("k"))
    b = table(spark, sf_dir, "lineitem").where("l_linenumber <= 2 and l_orderkey % 7 <> 0").select(F.col("l_orderkey").alias("k"))
    return records.merge_report(a, b, "k")


@query(
    """select page_id, concat(regexp_replace(url, '(?i)([?&](?:map_key|api_?key|key|token|secret|password)=)[^&#\\s]+', '\\1REDACTED', 'g'), case page_id % 4 when 0 then '?map_key=REDACTED&day=1' when 1 then '/api/area/csv/REDACTED/VIIRS' when 2 then ' Bearer REDACTED' else '' end) as source_uri,
    case when page_id % 2 = 0 then 'REDACTED' else 'plain' end as detail from pages"""
)
def secrets_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses and manifest values with planted secrets, redacted."""
    tail = F.expr("case page_id % 4 when 0 then concat('?map_key=s3cret', page_id, '&day=1') when 1 then concat('/api/area/csv/', page_id, 'abc/VIIRS') when 2 then concat(' Bearer ey', page_id, '.x_y-z') else '' end")
    d = table(spark, sf_dir, "pages").select("page_id", F.concat("url", tail).alias("u"))
    fields = records.redact_map(F.create_map(F.when(F.col("page_id") % 2 == 0, "X-Api-Key").otherwise("note"), F.when(F.col("page_id") % 2 == 0, F.col("u")).otherwise("plain")))
    return d.select("page_id", records.redact(F.col("u")).alias("source_uri"), F.element_at(F.map_values(fields), 1).alias("detail"))


@query(
    f"""with d as (select *, cast(acquired_at as date) as acq_date from {adapters.oracle('detections')} q), e as (select cast(min(acquired_at) - interval 24 hours as date) as a, cast(max(acquired_at) - interval 3 hours as date) as b from d where fire_id % 50 = 7 and event_type = 'purchase')
    select acq_date, count(*) as n from d, e where acq_date between a and b and acq_date >= date '2024-01-03' group by 1"""
)
def detections_in_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections of the dates that a batch of labels can see, from folders by date."""
    d = adapters.derived(spark, sf_dir, "detections").withColumn("acq_date", F.to_date("acquired_at"))
    path = shared_path(spark, "detections-by-date")
    d.repartition("acq_date").write.partitionBy("acq_date").parquet(path)
    held = records.in_dates(spark.read.parquet(path), "acq_date", first="2024-01-03")
    batch = d.where("fire_id % 50 = 7 and event_type = 'purchase'").select(F.col("acquired_at").alias("anchor_at"))
    return records.in_window_of(held, batch).groupBy("acq_date").agg(F.count("*").alias("n"))


# Perimeters: concentric squares that grow with a fire's events, one per half-day with an event.
SQUARES = """select fire_id, {day} as t, region, (fire_id*37 % 2000)*1e3 + 5e2 as cx, (fire_id*53 % 2000)*1e3 + 25e1 as cy, 2e2 + 4e1*sum(n) over (partition by fire_id order by day, half rows between unbounded preceding and current row) as hs
  from (select user_id as fire_id, case when user_id % 3 = 0 then 'Canada' else 'CONUS' end as region, cast(date_trunc('day', cast(ts as timestamp)) as timestamp) as day, case when hour(cast(ts as timestamp)) < 12 then 0 else 1 end as half, count(*) as n from events group by 1, 2, 3, 4) s"""
D_SQUARES = "(" + SQUARES.replace("{day}", "day + half * interval 12 hours") + ")"
D_PAIRS = f"(select a.fire_id, a.region, a.t, a.cx, a.cy, a.hs as h0, b.hs as h1 from {D_SQUARES} a join {D_SQUARES} b on a.fire_id = b.fire_id and a.region = b.region and b.t = a.t + interval 12 hours)"
#: The closed form of a square's share of a cell, and of the new part.
_OVER = "greatest(0, least(cx + {h}, (x + 1) * 1e3) - greatest(cx - {h}, x * 1e3)) * greatest(0, least(cy + {h}, (y + 1) * 1e3) - greatest(cy - {h}, y * 1e3))"
D_COVERED = f"""(select * from (select fire_id, region, t, x, y, ({_OVER.format(h='h1')} - {_OVER.format(h='h0')}) / 1e6 as overlap from (select *, unnest(range(cast(floor((cx - h1) / 1e3) as bigint), cast(ceil((cx + h1) / 1e3) as bigint))) as x from {D_PAIRS} p) q,
  lateral (select unnest(range(cast(floor((cy - h1) / 1e3) as bigint), cast(ceil((cy + h1) / 1e3) as bigint))) as y) r) s where overlap >= 1e-1 - 1e-12)"""


def _squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return made(spark, sf_dir, SQUARES.replace("{day}", "day + make_interval(0, 0, 0, 0, 12 * half)"), "events")


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.snapshot_pairs(_squares(spark, sf_dir), ["fire_id", "region"], "t")


def _covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = cut(_pairs(spark, sf_dir), "perimeter-pairs")
    corner = lambda r, sx, sy: f"struct({r}.cx {sx} {r}.hs as x, {r}.cy {sy} {r}.hs as y)"
    ring = lambda r: F.expr(f"array({corner(r, '-', '-')}, {corner(r, '+', '-')}, {corner(r, '+', '+')}, {corner(r, '-', '+')})")
    key = ["fire_id", "region", "t"]
    rings = pairs.select(*key, F.lit(True).alias("future"), ring("future").alias("ring")).unionByName(pairs.select(*key, F.lit(False).alias("future"), ring("current").alias("ring")))
    return labels.newly_covered_cells(labels.edges(rings, [*key, "future"]), key)


@query(f"select fire_id, region, t, h0 as current_half, h1 as future_half from {D_PAIRS} p")
def perimeter_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each perimeter with that of the same fire twelve hours later."""
    return _pairs(spark, sf_dir).select("fire_id", "region", "t", F.col("current.hs").alias("current_half"), F.col("future.hs").alias("future_half"))


@query(f"select fire_id, region, t, cast(x as int) as x, cast(y as int) as y, round(overlap, 6) as overlap from {D_COVERED} c")
def newly_covered_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of which a fire's next perimeter newly covers a tenth or more."""
    return rounded(_covered(spark, sf_dir), "overlap")


@query(f"select cast(x as int) as x, cast(y as int) as y, t as anchor_at, round(max(overlap), 6) as overlap, count(distinct fire_id) as contributing_fire_count, min(fire_id) as first_fire from {D_COVERED} c group by 1, 2, 3")
def label_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One label per cell and cutoff: the largest overlap, and the fires behind it."""
    merged = labels.merge_labels(_covered(spark, sf_dir).withColumnRenamed("t", "anchor_at"), ["fire_id", "region"])
    return rounded(merged.withColumn("first_fire", F.col("contributing_fires")[0]["fire_id"]).withColumn("contributing_fire_count", F.col("contributing_fire_count").cast("bigint")).drop("contributing_fires"), "overlap")


@query(
    f"""with s as {D_SQUARES}, k as (select t, fire_id from s union select t - interval 12 hours, fire_id from s), w as (select k.t, count(a.fire_id) as n_current, count(b.fire_id) as n_future, count(*) filter (a.fire_id is not null and b.fire_id is not null) as n_paired
      from k left join s a on a.t = k.t and a.fire_id = k.fire_id left join s b on b.t = k.t + interval 12 hours and b.fire_id = k.fire_id group by 1), p as (select t, count(*) as n from {D_COVERED} c group by 1)
    select w.t, n_current, n_future, n_paired, coalesce(n, 0) as n_positives, case when n_current = 0 then 'current' when n_future = 0 then 'future' end as missing_side, case when n_current = 0 or n_future = 0 or n is null then 'partial' else 'complete' end as status,
      case when n_current = 0 or n_future = 0 then 'missing-snapshot' when n_paired = 0 then 'no-paired-fire' when n is null then 'no-expansion' end as reason from w left join p using (t)"""
)
def label_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per half-day window: fires on both sides, labels, status and reason."""
    return labels.window_reports(_squares(spark, sf_dir), _covered(spark, sf_dir), "region", "t")


# A raster of parts in blocks of 10 rows; one in 41 pixels has no data.
RASTER = """select cast(floor(p_partkey / 2e2) as int) as b, cast(floor(p_partkey / 2e1) as int) % 10 as r, cast(p_partkey % 20 as int) as c, case when p_partkey % 41 = 0 then -32768 else cast(floor(p_retailprice) as int) end as elevation_m from part"""
_SHAPE = {"north": 60.0, "width": 1 / 240, "height": 1 / 240}
_D_RISE = "({b} - {a}) / case when {a0} and {b0} then 2 else 1 end"
D_SLOPE = f"""(with v as (select *, nullif(elevation_m, -32768) as z from {duck(RASTER)} q), n as (select v.*, w.b is null as w0, w.z as wz, e.b is null as e0, e.z as ez, t.b is null as t0, t.z as tz, s.b is null as s0, s.z as sz from v
  left join v w on w.b = v.b and w.r = v.r and w.c = v.c - 1 left join v e on e.b = v.b and e.r = v.r and e.c = v.c + 1 left join v t on t.b = v.b and t.c = v.c and t.r = v.r - 1 left join v s on s.b = v.b and s.c = v.c and s.r = v.r + 1),
  g as (select *, (case when e0 then z else ez end - case when w0 then z else wz end) / nullif((case when w0 then 0 else 1 end) + (case when e0 then 0 else 1 end), 0) / (6371008.8e0 * cos(radians(60 - (r + 5e-1) / 24e1)) * radians(1 / 24e1)) as east,
    -(case when s0 then z else sz end - case when t0 then z else tz end) / nullif((case when t0 then 0 else 1 end) + (case when s0 then 0 else 1 end), 0) / (6371008.8e0 * radians(1 / 24e1)) as north from n),
  h as (select *, degrees(atan(sqrt(east * east + north * north))) as slope from g)
  select b, r, c, elevation_m, case when z is null or slope is null then 0 else cast(least(180, round_even(slope * 2, 0)) as int) end as slope_x2,
    case when z is null or slope is null or slope < 5e-2 then 255 else cast(round_even(((degrees(atan2(-east, -north)) + 360) % 360) / 2, 0) as int) % 180 end as aspect_x2 from h)"""


def _pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terrain.slope_aspect(made(spark, sf_dir, RASTER, "part"), ["b"], _SHAPE["north"], _SHAPE["width"], _SHAPE["height"])


@query(f"select * from {D_SLOPE} s")
def slope_aspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantized slope and downhill aspect of every pixel."""
    return _pixels(spark, sf_dir)


# Points of events over the blocks: block k begins at 100 W + k / 16 degrees, so neighbours overlap.
POINTS = """select event_id, 60 - ((event_id * 37 % 1100) / 1000e0) * 10 / 24e1 as latitude, -100 + (user_id % 12) / 16e0 + ((event_id * 53 % 1300) / 1000e0) * 20 / 24e1 as longitude from events"""
BLOCKS = "select distinct b as block_id, 20 as width, 10 as height, -100 + b / 16e0 as west, 60e0 as north, 1 / 24e1 as pixel_width, 1 / 24e1 as pixel_height from {r} q"
_SNAP = "cast(floor(case when abs({v} - round_even({v}, 0)) <= 1e-9 then round_even({v}, 0) else {v} end) as int)"


@query(
    f"""with p as {duck(POINTS)}, k as ({BLOCKS.replace('{r}', duck(RASTER))}), m as (select p.*, block_id, {_SNAP.format(v='((north - latitude) / pixel_height)')} as row, {_SNAP.format(v='((longitude - west) / pixel_width)')} as col from p, k),
    i as (select *, least(row, col, 9 - row, 19 - col) as edge from m where row between 0 and 9 and col between 0 and 19), w as (select event_id, arg_min(block_id, row(-edge, block_id)) as block_id, arg_min(row, row(-edge, block_id)) as row, arg_min(col, row(-edge, block_id)) as col from i group by 1),
    s as (select p.event_id, w.block_id, row, col, t.elevation_m, t.slope_x2, t.aspect_x2 from p left join w using (event_id) left join {D_SLOPE} t on t.b = w.block_id and t.r = w.row and t.c = w.col),
    z as (select *, case when block_id is null then 'outside-retained-terrain-coverage' when elevation_m is null or elevation_m = -32768 then 'source-no-data' else 'sampled' end as terrain_status from s)
    select event_id, block_id, row, col, terrain_status, case when terrain_status = 'sampled' then elevation_m * 1e0 end as terrain_elevation_m, case when terrain_status = 'sampled' then slope_x2 / 2e0 end as terrain_slope,
      round(case when terrain_status = 'sampled' then case when aspect_x2 <> 255 then sin(radians(aspect_x2 * 2e0)) else 0 end end, 6) as terrain_aspect_sin, round(case when terrain_status = 'sampled' then case when aspect_x2 <> 255 then cos(radians(aspect_x2 * 2e0)) else 0 end end, 6) as terrain_aspect_cos,
      terrain_status = 'sampled' and coalesce(aspect_x2 <> 255, false) as terrain_aspect_defined from z"""
)
def terrain_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terrain of every point from the best of the blocks that hold it."""
    pixels = cut(_pixels(spark, sf_dir).withColumnRenamed("b", "block_id"), "terrain-pixels")
    blocks = spark.sql(BLOCKS.replace("{r}", "(select block_id as b from {t})"), t=pixels)
    found = terrain.sample(made(spark, sf_dir, POINTS, "events"), "event_id", blocks, pixels)
    return rounded(found.drop("latitude", "longitude").fillna(False, ["terrain_aspect_defined"]), "terrain_aspect_sin", "terrain_aspect_cos")


_TILES = """select distinct concat('t', cast(tx as {S}), ':', cast(ty as {S})) as tile_id, tx / 8e0 as west, ty / 8e0 as south, (tx + 1) / 8e0 as east, (ty + 1) / 8e0 as north from (select cast(floor((-120 + (user_id*29 % 500) / 1e1) * 8) as int) as tx, cast(floor((35 + (user_id*17 % 250) / 1e1) * 8) as int) as ty from events) q"""


@query(
    f"""with t as {duck(_TILES)}, b as (select cast(floor((west + 180) / 10) as int) as bx, cast(floor((south + 90) / 10) as int) as "by", tile_id from t)
    select bx, "by", count(*) as n_tiles, array_to_string(list_sort(list(tile_id)), ' ') as tile_ids, round(greatest(-180, -180 + bx * 10 - 1 / 24e1), 6) as request_west, round(least(180, -170 + bx * 10 + 1 / 24e1), 6) as request_east,
      round(greatest(-90, -90 + "by" * 10 - 1 / 24e1), 6) as request_south, round(least(90, -80 + "by" * 10 + 1 / 24e1), 6) as request_north, 2402 as width, 2402 as height from b group by 1, 2"""
)
def source_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-degree source blocks of the context tiles, with a pixel around them."""
    found = terrain.source_blocks(made(spark, sf_dir, _TILES, "events"))
    return rounded(found, "request_west", "request_east", "request_south", "request_north")
