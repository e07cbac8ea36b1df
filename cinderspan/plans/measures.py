"""Queries of measures, covers, views, weather and transitions, with their SQL."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspan.functions import grid
from cinderspan.operators import evaluate, frontier, incidents, ledger, release, spatial, views, weather
from cinderspan.plans.catalog import _SQL, D_BINS, incident_groups, query, rounded
from cinderspan.plans.records import duck, made
from cinderspan.plans.transitions import D_FRONTIER, _frontier, _state
from cinderspan.session import shared_path, table
from cinderspan.sources import adapters

S = adapters.oracle("scores")
SCORED = "select event_id, cast(ts as date) as day, case when event_type = 'purchase' then 1 else 0 end as y, (event_id*7919 % 997) / 997e0 as p, cast(user_id % 4 as int) as split_no, cast(event_id % 8 + 1 as int) as step, case when event_id % 11 <> 0 then value end as f from events"


@query(f"with b as (select split_no, cast(least(floor(p * 10), 9) as int) as bin, count(*) as n, abs(avg(p) - avg(y)) as g from {S} s group by 1, 2) select split_no, round(sum(n * g) / sum(n), 6) as ece, round(max(g), 6) as mce, cast(sum(n) as bigint) as n from b group by 1")
def calibration_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.calibration_errors(adapters.derived(spark, sf_dir, "scores"), ["split_no"]), "ece", "mce")


D_PARTS = f"(with t as (select distinct day from {duck(SCORED)} s), k as (select day, row_number() over (order by day) as k, count(*) over () as n from t) select s.*, case when k <= floor(n * 8e-1) then 'train' else 'evaluation' end as part from {duck(SCORED)} s join k using (day))"


@query(f"select event_id, part from {D_PARTS} q")
def holdout_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side of every row in a chronological hold-out by distinct days."""
    return evaluate.holdout_masks(made(spark, sf_dir, SCORED, "events"), "day", 0.8).select("event_id", "part")


@query(f"select part, count(*) as n_rows, cast(sum(y) as bigint) as n_positive, min(day) as first_at, max(day) as last_at, count(*) filter (f is null) as missing_f, 0 as missing_p from {D_PARTS} q group by 1")
def feature_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, positives, period and missing values of both sides of the hold-out."""
    d = evaluate.holdout_masks(made(spark, sf_dir, SCORED, "events"), "day", 0.8)
    return evaluate.feature_contract(d, "part", "day", "y", ["f", "p"])


REPORTS = f"""select split_no, step, event_id % 5 as seq, count(case when y = 1 and p >= 5e-1 then 1 end) as tp, count(case when y = 0 and p >= 5e-1 then 1 end) as fp, count(case when y = 1 and p < 5e-1 then 1 end) as fn, count(case when y = 0 and p < 5e-1 then 1 end) as tn,
  count(case when event_id % 10 <> 3 then 1 end) as covered, avg((y - p) * (y - p)) as brier, case when event_id % 5 = 2 then null else avg(p) * 1000 end as distance from {{s}} s group by split_no, step, event_id % 5"""


@query(
    f"""with r as ({REPORTS.replace('{s}', duck(SCORED))}), g as (select split_no, step, count(*) as sequence_count, cast(sum(tp) as bigint) as tp, cast(sum(fp) as bigint) as fp, cast(sum(fn) as bigint) as fn, cast(sum(tn) as bigint) as tn, cast(sum(covered) as bigint) as covered, cast(sum(tp + fp + fn + tn) as bigint) as row_count,
      round(sum(brier * (tp + fp + fn + tn)) / sum(tp + fp + fn + tn), 6) as brier, round(avg(abs(fp - fn)), 6) as area_mae, round(avg(distance), 6) as mean_distance, count(distance) as defined_distances, count(*) - count(distance) as undefined_distances from r group by 1, 2)
    select *, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall, round((tp + tn) / row_count, 6) as accuracy, round(covered / row_count, 6) as coverage from g"""
)
def horizon_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence reports pooled by split and horizon."""
    reports = spark.sql(REPORTS.replace("{s}", "{t}"), t=made(spark, sf_dir, SCORED, "events"))
    return rounded(evaluate.pooled_summary(reports, ["split_no", "step"]), "brier", "area_mae", "mean_distance", "precision", "recall", "accuracy", "coverage")


OBSERVED = "select event_id, 300 + least(value, 1e2) * 67e-2 as brightness, cast(1 + event_id % 9 as int) as detections, cast(1 + event_id % 3 as int) as platforms from events where value is not null"
D_BIN = "cast(least(floor(least(1, greatest(0, (brightness - 305) / 62e0)) * 5), 4) as int)"
D_CALIBRATION = f"(with b as (select {D_BIN} as bin, count(*) as n, avg(detections) as d, avg(platforms) as p from {duck(OBSERVED)} o group by 1), w as (select avg(detections) as d, avg(platforms) as p from {duck(OBSERVED)} o) select cast(g.bin as int) as bin, coalesce(n, 0) as n, coalesce(b.d, w.d) as detections, coalesce(b.p, w.p) as platforms from range(5) g(bin) left join b on b.bin = g.bin, w)"


@query(f"select bin, n, round(detections, 6) as detections, round(platforms, 6) as platforms from {D_CALIBRATION} c")
def intensity_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean detections and platforms by brightness bin."""
    return rounded(evaluate.intensity_calibration(made(spark, sf_dir, OBSERVED, "events"), "brightness", ["detections", "platforms"]), "detections", "platforms")


@query(f"select event_id, greatest(1, floor(c.detections + 5e-1)) as detections, least(greatest(1, floor(c.detections + 5e-1)), greatest(1, floor(c.platforms + 5e-1))) as platforms from {duck(OBSERVED)} o join {D_CALIBRATION} c on c.bin = {D_BIN}")
def rendered_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic counts of every observation by the calibrated bins."""
    o = made(spark, sf_dir, OBSERVED, "events")
    calibration = evaluate.intensity_calibration(o, "brightness", ["detections", "platforms"])
    cells = o.select("event_id", evaluate.intensity("brightness").alias("intensity"))
    return evaluate.rendered_counts(cells, calibration).select("event_id", F.col("detections").cast("double").alias("detections"), F.col("platforms").cast("double").alias("platforms"))


FRONTS = "select distinct fire_id, x, y, event_type = 'purchase' as predicted from {l} l"
_BOUND = "(select fire_id, x, y from {m} m where not exists (select 1 from {m} n where n.fire_id = m.fire_id and n.x = m.x + 1 and n.y = m.y) or not exists (select 1 from {m} n where n.fire_id = m.fire_id and n.x = m.x - 1 and n.y = m.y) or not exists (select 1 from {m} n where n.fire_id = m.fire_id and n.x = m.x and n.y = m.y + 1) or not exists (select 1 from {m} n where n.fire_id = m.fire_id and n.x = m.x and n.y = m.y - 1))"


@query(
    f"""with c as ({FRONTS.replace('{l}', adapters.located_oracle())}), p as (select fire_id, x, y from c where predicted), o as (select fire_id, x, y from c where not predicted), bp as {_BOUND.replace('{m}', 'p')}, bo as {_BOUND.replace('{m}', 'o')},
    d as (select bp.fire_id, bp.x as px, bp.y as py, bo.x as ox, bo.y as oy, sqrt((bp.x - bo.x) ** 2 + (bp.y - bo.y) ** 2) as d from bp join bo using (fire_id)), a as (select fire_id, avg(m) as m, max(m) as h from (select fire_id, px, py, min(d) as m from d group by all) group by 1), b as (select fire_id, avg(m) as m, max(m) as h from (select fire_id, ox, oy, min(d) as m from d group by all) group by 1)
    select g.fire_id, round((a.m + b.m) / 2 * 1000, 4) as front_mean_m, round(greatest(a.h, b.h) * 1000, 4) as front_hausdorff_m, case when a.m is null then 'undefined-empty-front' else 'measured' end as front_status from (select distinct fire_id from c) g left join a using (fire_id) left join b using (fire_id)"""
)
def front_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the fronts of two masks of every fire."""
    c = spark.sql(FRONTS, l=adapters.located(spark, sf_dir))
    found = spatial.front_distances(*(c.where(F.col("predicted") == v).select("fire_id", "x", "y") for v in (True, False)), ["fire_id"])
    return rounded(found, "front_mean_m", "front_hausdorff_m", digits=4)


_REACH = 20_000.0


_D_ECEF = "(select *, {c} as id, nu * cos(f) * cos(l) as px, nu * cos(f) * sin(l) as py, nu * (1 - e2) * sin(f) as pz from (select *, 6378137e0 / sqrt(1 - e2 * power(sin(f), 2)) as nu from (select distinct longitude, latitude, radians(latitude) as f, radians(longitude) as l, 1 - power(1 - 1 / 298.257222101e0, 2) as e2 from {t} t0)))"


@query(
    f"""with recursive d as {adapters.oracle('detections')}, p as (select *, row_number() over (order by longitude, latitude) as i from {_D_ECEF.format(c='0', t='d')} e),
    nb as (select a.i as i, list(b.i) as near from p a join p b on b.i > a.i and abs(a.px - b.px) <= {_REACH} and abs(a.py - b.py) <= {_REACH} and sqrt((a.px - b.px) ** 2 + (a.py - b.py) ** 2 + (a.pz - b.pz) ** 2) <= {_REACH} group by 1),
    r as (select cast(null as bigint) as taken, (select list(i order by i) from p) as rest
      union all select rest[1], list_filter(rest[2:], lambda x: not list_contains(coalesce(near, []), x)) from r left join nb on nb.i = rest[1] where len(rest) > 0)
    select longitude, latitude from r join p on p.i = r.taken"""
)
def weather_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The greedy cover of all detection places within 20 km."""
    return spatial.covering_sources(adapters.derived(spark, sf_dir, "detections").select("longitude", "latitude"), _REACH)


@query(
    f"""with d as {adapters.oracle('detections')}, a as {_D_ECEF.format(c='row(longitude, latitude)', t='d')}, b as {_D_ECEF.format(c='row(longitude, latitude)', t="(select * from d where fire_id % 5 = 0 and event_type = 'purchase')")},
    m as (select a.longitude, a.latitude, b.longitude as blon, b.latitude as blat, sqrt((a.px - b.px) ** 2 + (a.py - b.py) ** 2 + (a.pz - b.pz) ** 2) as d from a join b on a.latitude between b.latitude - 2e-1 and b.latitude + 2e-1 and abs(a.px - b.px) <= {_REACH} and abs(a.py - b.py) <= {_REACH}),
    r as (select *, row_number() over (partition by longitude, latitude order by d, blon, blat) as k from m where d <= {_REACH}) select longitude, latitude, round(d, 3) as distance from r where k = 1"""
)
def nearest_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of every place to the nearest of a set of sources within 20 km."""
    d = adapters.derived(spark, sf_dir, "detections")
    found = spatial.nearest_source(d, d.where("fire_id % 5 = 0 and event_type = 'purchase'"), _REACH)
    return rounded(found.select("longitude", "latitude", "distance"), "distance", digits=3)


# Last squares of fires, and candidate points scattered around them.
LAST = """select user_id as fire_id, (user_id*37 % 2000)*1e3 + 5e2 as cx, (user_id*53 % 2000)*1e3 + 25e1 as cy, 2e2 + 4e1*count(*) as hs from events group by user_id"""
NEAR = """select event_id, (user_id*37 % 2000)*1e3 + 5e2 + ((event_id*131) % 16001 - 8000) as px, (user_id*53 % 2000)*1e3 + 25e1 + ((event_id*197) % 16001 - 8000) as py from events"""


@query(
    f"""with d as (select event_id, fire_id, sqrt(greatest(0, abs(px - cx) - hs) ** 2 + greatest(0, abs(py - cy) - hs) ** 2) as distance from {duck(NEAR)} p join {duck(LAST)} s on abs(px - cx) <= hs + 5000 and abs(py - cy) <= hs + 5000) select event_id, fire_id, round(distance, 4) as distance from d where distance <= 5000"""
)
def perimeter_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate points with the perimeters within 5 km; zero inside."""
    corner = lambda sx, sy: f"struct(cx {sx} hs as x, cy {sy} hs as y)"
    squares = made(spark, sf_dir, LAST, "events").select("fire_id", F.expr(f"array({corner('-', '-')}, {corner('+', '-')}, {corner('+', '+')}, {corner('-', '+')})").alias("ring"))
    return rounded(spatial.perimeter_distances(made(spark, sf_dir, NEAR, "events"), ["event_id"], squares, ["fire_id"], 5000.0), "distance", digits=4)


D_GROUPS = f"""(with recursive boxes as (select fire_id, min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1 from {adapters.located_oracle()} l group by 1),
  links as (select a.fire_id as a, b.fire_id as b from boxes a join boxes b on greatest(0, a.x0 - b.x1, b.x0 - a.x1) ** 2 + greatest(0, a.y0 - b.y1, b.y0 - a.y1) ** 2 <= 400),
  reach as (select fire_id as a, fire_id as g from boxes union select l.b, r.g from reach r join links l on l.a = r.a) select a as fire_id, min(g) as group_id from reach group by 1)"""


_SQL["incident_groups"] = f"select * from {D_GROUPS} g"


@query(_SQL["incident_groups"])
def incident_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fires within 20 km of each other as connected groups."""
    return incident_groups(spark, sf_dir)


@query(
    f"""with r as (select g.group_id, l.*, {grid.region_key('x', 'y', 100)} as region_key from {adapters.located_oracle()} l join {D_GROUPS} g using (fire_id)), m as (select group_id, list_sort(list(distinct cast(fire_id as varchar))) as m, list_sort(list(distinct region_key)) as k, count(*) as n_rows, min(acquired_at) as first_at, max(acquired_at) as last_at from r group by 1)
    select group_id, concat('feds-complex-v1:', substr(sha256(array_to_string(m, chr(10))), 1, 24)) as incident_group_id, len(m) as n_members, array_to_string(m, ' ') as members, array_to_string(k, ' ') as regions, n_rows, first_at, last_at from m"""
)
def incident_group_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members, regions, rows and period of every group of fires."""
    return incidents.group_summary(adapters.located(spark, sf_dir), incident_groups(spark, sf_dir), "fire_id", "acquired_at", cells=100)


# --- views and releases ---

ENTRIES = """select o_custkey % 40 as snapshot_id, case when o_orderkey % 10 < 6 then 'complete' else 'partial' end as status, case when o_orderkey % 5 <> 0 and o_custkey % 8 <> 0 then concat('a', cast(o_orderkey % 6 as {S})) end as artifact_id, cast(o_orderdate as timestamp) as recorded_at, o_orderkey as append_order from orders"""
FILES = "select distinct o_custkey % 40 as snapshot_id, concat('a', cast(o_orderkey % 6 as {S})) as artifact_id from orders"


@query(f"with n as (select snapshot_id, arg_max(artifact_id, row(recorded_at, append_order)) as chosen from {duck(ENTRIES)} e where status = 'complete' and artifact_id is not null group by 1) select f.* from {duck(FILES)} f left join n using (snapshot_id) where chosen is null or artifact_id = chosen")
def revision_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one revision of each snapshot that the ledger names; all files where it names none."""
    return views.select_revision(made(spark, sf_dir, ENTRIES, "orders"), made(spark, sf_dir, FILES, "orders"), "snapshot_id")


CAPTURES = "select cast(date_trunc('month', o_orderdate) as timestamp) as captured_at, cast(o_orderdate as timestamp) as start_at, cast(o_orderdate as timestamp) + interval 3 days as end_at from orders"


@query(f"with h as (select captured_at, count(distinct row(start_at, end_at)) as n_windows from {duck(CAPTURES)} c where start_at < timestamp '1996-09-01' and end_at > timestamp '1995-01-15' group by 1) select captured_at, n_windows from h order by n_windows desc, captured_at desc limit 1")
def capture_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The capture that covers most of a range of dates."""
    return views.select_capture(made(spark, sf_dir, CAPTURES, "orders"), "1995-01-15", "1996-08-31")


@query("select event_id, user_id, event_type from events where event_id % 2 = 1")
def view_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view published twice and read by its newest manifest."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    folder, manifests = shared_path(spark, "views"), shared_path(spark, "manifests")
    for build, part in (("b1", events.where("event_id % 2 = 0")), ("b2", events.where("event_id % 2 = 1"))):
        views.publish(spark, part, folder, build, "candidates", "v1", ["event_type"], manifests)
    return views.read_view(spark, spark.read.parquet(manifests), "candidates", "v1", "event_id").select("event_id", "user_id", "event_type")


BUILDS = "select concat('b', cast(user_id % 50 as {S})) as build_id, case when user_id % 50 = 17 then 'p2' else 'p1' end as policy, cast(min(ts) as date) as start_on, cast(min(ts) as date) + cast(user_id % 50 % 3 as int) as end_on from events group by user_id % 50, case when user_id % 50 = 17 then 'p2' else 'p1' end"


@query(f"with s as (select *, lag(end_on) over (order by start_on, build_id) as before, min(policy) over () as least from {duck(BUILDS)} b), f as (select build_id, case when policy <> least then 'policy' when start_on > before + 1 then 'gap' when start_on <= before then 'overlap' end as fault from s) select * from f where fault is not null")
def builds_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why builds cannot be merged into one."""
    return views.merge_faults(made(spark, sf_dir, BUILDS, "events"))


@query("""select concat('{"event_id":', event_id, ',"user_id":', user_id, ',"value":', case when event_id % 10 = 0 or value is null then 'null' else cast(cast(floor(value) as bigint) as varchar) || '.0' end, '}') as line from events""")
def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as canonical JSON lines; numbers that are none are null."""
    value = F.when(F.col("event_id") % 10 == 0, F.lit(float("nan"))).otherwise(F.floor("value").cast("double"))
    return views.jsonl(table(spark, sf_dir, "events").select("user_id", "event_id", value.alias("value")))


_D_ROW = """sha256(concat('{"event_id":', event_id, ',"event_type":"', event_type, '","user_id":', user_id, '}'))"""


@query(f"with d as (select count(*) as n, sum(cast(concat('0x', substr({_D_ROW}, 1, 15)) as hugeint)) as s from events) select n as n_a, cast(s as varchar) as digest_a, n as n_b, cast(s as varchar) as digest_b, true as same from d")
def release_equivalent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table and its shuffled copy have one digest."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    found = views.equivalent(events, events.select("user_id", "event_type", "event_id").repartition(7, "user_id"))
    return found.withColumns({c: F.col(c).cast("string") for c in ("digest_a", "digest_b")})


@query("select concat('part=', event_type) as name, 'changed' as fault from events where event_type = 'purchase' group by 1, 2 union all select 'part=none', 'missing'")
def release_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of a release of one folder for each kind of event: a changed digest and a missing folder are planted."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    folder = shared_path(spark, "release")
    events.repartition("event_type").write.partitionBy("event_type").option("compression", "none").parquet(folder)
    files = views.inventory(spark, folder, "*.parquet")
    faults = views.verification_faults(files, files)
    # By folder rather than by file, whose names are Spark's own.
    held = spark.read.parquet(folder).groupBy(F.concat(F.lit("part="), "event_type").alias("name")).agg(F.sha2(F.count("*").cast("string"), 256).alias("sha256"))
    listed = held.withColumn("sha256", F.when(F.col("name") == "part=purchase", F.lit("0")).otherwise(F.col("sha256"))).unionByName(held.limit(1).select(F.lit("part=none").alias("name"), "sha256"))
    return views.verification_faults(held, listed).unionByName(faults)


@query("with r as (select o_custkey % 25 as product, min(cast(o_orderdate as timestamp)) as a, max(cast(o_orderdate as timestamp)) + interval 5 hours as b from orders group by 1) select product, t as start_at, least(t + interval 720 hours, b) as end_at from r, lateral (select unnest(generate_series(a, b - interval 1 microsecond, interval 720 hours)) as t)")
def expected_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirty-day collection windows of every product, the last one cut."""
    ends = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 25).alias("product")).agg(F.min(F.col("o_orderdate").cast("timestamp")).alias("a"), (F.max(F.col("o_orderdate").cast("timestamp")) + F.expr("interval 5 hours")).alias("b"))
    return ends.select("product", F.explode(ledger.expected_windows(F.col("a"), F.col("b"), 720)).alias("w")).select("product", F.col("w.start").alias("start_at"), F.col("w.end").alias("end_at"))


@query(
    """with u as (select coalesce(source, 'other') as category, sum(octet_length(encode(coalesce(text, '')))) as used from documents group by 1), w as (select concat('x', source) as category, 10 as wanted from documents where source is not null group by 1 union all select category, case when used % 2 = 0 then 3000000000 else 5 end from u)
    select w.category, cast(w.wanted as bigint) as wanted, w.category in (select category from u) and wanted = 5 as admitted, case when w.category not in (select category from u) then 'unknown-category' when wanted > 5 then 'category-cap' else 'fits' end as reason from w"""
)
def storage_admitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether wanted bytes fit each category."""
    files = spark.sql("select coalesce(source, 'other') as category, octet_length(encode(coalesce(text, ''), 'utf-8')) as bytes from {t}", t=table(spark, sf_dir, "documents"))
    caps = files.select("category").distinct().withColumn("cap", F.lit(2_000_000_000))
    usage = release.storage_usage(files, caps.select("category", F.col("cap").cast("bigint").alias("cap")), 20_000_000_000)
    own = usage.where("category <> 'whole-data'").select("category", F.when(F.col("used") % 2 == 0, 3_000_000_000).otherwise(5).cast("bigint").alias("wanted"))
    more = table(spark, sf_dir, "documents").where("source is not null").select(F.concat(F.lit("x"), "source").alias("category"), F.lit(10).cast("bigint").alias("wanted")).distinct()
    return views.admission(usage, own.unionByName(more))


# --- weather ---


@query(
    """with p as (select l_orderkey as payload_id, cast(min(l_shipdate) as date) as day, count(*) as n from lineitem group by 1), h as (select payload_id, day, unnest(range(0, n)) as k from p),
    v as (select payload_id, day, k, 'speed' as variable, (payload_id + k) % 20 * 1e0 as value from h where k % 3 <> 2 union all select payload_id, day, k, 'direction', (payload_id * 7 + k * 31) % 360 * 1e0 from h),
    w as (select a.payload_id, a.day, a.k, a.value as s, b.value as d from v a join v b using (payload_id, day, k) where a.variable = 'speed' and b.variable = 'direction'),
    al as (select * from v union all select payload_id, day, k, 'wind_u', -s * sin(radians(d)) from w union all select payload_id, day, k, 'wind_v', -s * cos(radians(d)) from w)
    select payload_id, day + k * interval 1 hour as observed_at, variable, round(value, 6) + 0e0 as value, concat('weather:', sha256(concat_ws('|', concat('m:', printf('%.5f', 50 + payload_id % 100 / 1e2), ':', printf('%.5f', -110e0)), strftime(day + k * interval 1 hour, '%Y-%m-%dT%H'), variable))) as measurement_id from al"""
)
def hourly_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of parallel arrays as long rows with the wind's components and ids."""
    p = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("payload_id")).agg(F.to_date(F.min("l_shipdate")).alias("day"), F.count("*").cast("int").alias("n"))
    hours = "sequence(0, n)"  # one hour more than there are, of which arrays hold nothing
    payloads = p.select(
        "payload_id", "day", F.expr(f"transform({hours}, k -> date_format(cast(day as timestamp) + make_interval(0, 0, 0, 0, k), \"yyyy-MM-dd'T'HH:mm\"))").alias("time"),
        F.expr(f"transform({hours}, k -> case when k = n or k % 3 = 2 then null else double((payload_id + k) % 20) end)").alias("speed"),
        F.expr(f"transform({hours}, k -> case when k = n then double('NaN') else double((payload_id * 7 + k * 31) % 360) end)").alias("direction"),
    )
    long = weather.with_wind(weather.explode_hourly(payloads, ["payload_id"], "time", ["speed", "direction"]), ["payload_id", "observed_at"], "speed", "direction")
    named = long.withColumn("grid_id", weather.grid_id("'m'", "50 + payload_id % 100 / 1e2", "-110e0")).withColumn("hour", F.date_format("observed_at", "yyyy-MM-dd'T'HH"))
    return rounded(named.withColumn("measurement_id", weather.measurement_id("grid_id", "hour", "variable")).drop("grid_id", "hour"), "value")


ISSUED = """select l_orderkey * 10 + l_linenumber as seq, concat('g', cast(l_partkey % 50 as {S})) as source_grid_id, concat('v', cast(l_suppkey % 5 as {S})) as variable, cast(l_shipdate as timestamp) as run_at,
  case when l_orderkey % 5 > 1 then cast(l_shipdate as timestamp) + cast(floor(l_quantity) - 3 as int) * interval '1' hour end as availability_at, case when l_orderkey % 5 > 0 then cast(l_shipdate as timestamp) + interval '4' hour end as published_at,
  cast(l_shipdate as timestamp) + cast(l_orderkey % 48 as int) * interval '1' hour as valid_at, case when l_partkey % 90 <> 0 then 50e0 end as latitude, -110e0 as longitude from lineitem"""


@query(
    f"""with f as (select *, coalesce(availability_at, published_at) as known_at from {duck(ISSUED)} q) select seq, known_at, case when availability_at is not null then 'explicit' when published_at is not null then 'published' end as availability_basis, round((epoch_us(valid_at) - epoch_us(run_at)) / 3.6e9, 6) as lead_hours,
    case when known_at is null then 'no-availability' when known_at < run_at then 'available-before-run' when latitude is null then 'half-a-coordinate' end as fault, sha256(concat_ws('|', source_grid_id, variable, cast(epoch_us(run_at) // 1000000 as varchar), cast(epoch_us(valid_at) // 1000000 as varchar))) as forecast_id from f"""
)
def forecasts_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issued forecasts with their availability, lead, id and fault."""
    found = weather.normalize_forecasts(made(spark, sf_dir, ISSUED, "lineitem"), ["source_grid_id", "variable"])
    return rounded(found.select("seq", "known_at", "availability_basis", "lead_hours", "fault", "forecast_id"), "lead_hours")


_WANTED = "select distinct cast(l_shipdate as date) as day, l_partkey % 30 as tile, concat('v', cast(k as {S})) as variable from lineitem, {r}"
_HAVE = "select distinct cast(l_shipdate as date) as day, l_partkey % 30 as tile, concat('v', cast(l_suppkey % 3 as {S})) as variable from lineitem"


@query(f"with w as {duck(_WANTED.replace('{r}', 'range(3) r(k)'))}, h as {duck(_HAVE)}, t as (select w.day, w.tile, count(*) as w, count(h.tile) as h from w left join h using (day, tile, variable) group by 1, 2) select day, cast(sum(w) as bigint) as n_required, cast(sum(h) as bigint) as n_present, count(*) filter (h < w) as n_partial_tiles, bool_and(h = w) as complete from t group by 1")
def backfill_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per day: required and present values, partial tiles, completeness."""
    have = made(spark, sf_dir, _HAVE, "lineitem")
    wanted = have.select("day", "tile").distinct().select("day", "tile", F.explode(F.array(*(F.lit(f"v{k}") for k in range(3)))).alias("variable"))
    return weather.backfill_report(wanted, have, "day", ["tile", "variable"])


LINEAGE = "select user_id, {a}(concat('raw-', cast(event_id % 30 as {S})), case when event_id % 2 = 0 then concat('raw-', cast(user_id % 30 as {S})) end) as raw_ids, case when event_id % 3 = 0 then {a}(concat('fed-', cast(event_id % 7 as {S}))) end as label_ids from events"


@query("with i as (select user_id, concat('raw-', event_id % 30) as id from events union select user_id, concat('raw-', user_id % 30) from events where event_id % 2 = 0 union select user_id, concat('fed-', event_id % 7) from events where event_id % 3 = 0), g as (select user_id, list_sort(list(id)) as ids, count(*) as n_ids from i group by 1) select user_id, array_to_string(ids, ' ') as ids, n_ids, list_contains(ids, 'raw-7') as shares from g")
def lineage_united(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted distinct ids behind every fire, and whether a release shares one."""
    d = made(spark, sf_dir, LINEAGE.replace("{a}", "array"), "events").withColumn("raw_ids", F.array_compact("raw_ids"))
    found = views.lineage_union(d, ["user_id"], ["raw_ids", "label_ids"])
    return found.select("user_id", F.array_join("ids", " ").alias("ids"), "n_ids", F.arrays_overlap("ids", F.array(F.lit("raw-7"))).alias("shares"))


# --- transitions ---

CENTRES = "select cast(acquired_at as date) as scenario, x, y, count(*) as n, max(bright_ti4) as brightness, hour(max(acquired_at)) * 1e0 as age_h from {l} l group by 1, 2, 3"
D_ACTIVE = f"(select scenario, x, y, max(least(1, greatest(0, (brightness - 305) / 62e0))) as intensity, min(age_h) as age_h from ({CENTRES.replace('{l}', adapters.located_oracle())}) c where age_h between 3 and 24 group by 1, 2, 3)"


@query(f"select scenario, x, y, round(intensity, 6) as intensity, age_h from {D_ACTIVE} a")
def observed_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active cells of every day from observed centres of an age that counts."""
    return rounded(frontier.observed_state(spark.sql(CENTRES, l=adapters.located(spark, sf_dir))), "intensity")


@query(
    f"""with {D_FRONTIER}, a as (select *, cast(ceil(3 * intensity) as bigint) + 1 as n, 305 + 62 * intensity as b, cast(1 + abs(x) % 3 as int) as pl from {D_ACTIVE} q), m as (select scenario, cast(x + dx as int) as x, cast(y + dy as int) as y, n, b, pl, age_h from a, range(-1, 2) r(dx), range(-1, 2) t(dy)),
    g as (select scenario, x, y, sum(n) as local_count, max(b) as local_max, sum(b * n) / sum(n) as local_mean, max(pl) as local_platforms, min(age_h) as local_hours_since, count(*) as local_active_cells from m group by 1, 2, 3)
    select f.scenario, f.x, f.y, cast(coalesce(local_count, 0) as bigint) as local_count, round(local_max, 6) as local_max, round(local_mean, 6) as local_mean, coalesce(local_platforms, 0) as local_platforms, local_hours_since, coalesce(local_active_cells, 0) as local_active_cells, case when local_active_cells is null then 0 else 1 end as local_has
    from front f left join g using (scenario, x, y)"""
)
def frontier_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered local features of every frontier cell."""
    active = frontier.observed_state(spark.sql(CENTRES, l=adapters.located(spark, sf_dir)))
    active = active.withColumns({"detections": F.ceil(3 * F.col("intensity")) + 1, "platforms": (1 + F.abs("x") % 3).cast("int")})
    return rounded(frontier.frontier_features(_frontier(spark, sf_dir)[1], active), "local_max", "local_mean")


@query(
    f"""with {D_FRONTIER}, c as (select cast(scenario + interval 1 day as date) as scenario, x, y from front), d as (select scenario, x, y, case when intensity > 5e-1 then 1 else 0 end as t from state)
    select coalesce(c.scenario, d.scenario) as scenario, count(*) filter (c.x is not null and d.x is not null) as matched, count(*) filter (c.x is not null and t = 1) as matched_positives, count(*) filter (c.x is null) as unreached, count(*) filter (c.x is null and t = 1) as unreached_positives, count(*) filter (d.x is null) as outside
    from c full join d on c.scenario = d.scenario and c.x = d.x and c.y = d.y group by 1"""
)
def next_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the frontier of each day meets the cells of the next."""
    state, front = _frontier(spark, sf_dir)
    moved = front.withColumn("scenario", F.date_add("scenario", 1))
    return frontier.pair_report(moved, state.withColumn("target", (F.col("intensity") > 0.5).cast("int")))


@query(
    f"""with b as ({D_BINS}), n as (select *, case when t - lag(t) over w = interval 12 hours then 0 else 1 end as fresh from b window w as (partition by fire_id order by t)), s as (select fire_id, t, cast(sum(fresh) over (partition by fire_id order by t) as bigint) as sequence from n),
    p as (select *, row_number() over (partition by fire_id, sequence order by t) - 1 as k from s) select fire_id, sequence, t, cast(k // 8 as int) as fragment, cast(k % 8 as int) as "offset", case when k % 8 > 0 then [25e-2, 5e-1, 75e-2][1 + cast(least(2, (k % 8 - 1) * 3 // 7) as int)] end as predicted_fraction from p"""
)
def sequence_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of half-days in pieces of eight steps with the share of predicted state."""
    d = adapters.derived(spark, sf_dir, "detections").select("fire_id", F.window("acquired_at", "12 hours").start.alias("t"))
    return frontier.fragments(ledger.gap_sequences(d, ["fire_id"], "t"), ["fire_id", "sequence"]).drop("place")


@query("with r as (select event_id, cast(concat('0x', substr(sha256(concat('0:subset:', event_id)), 1, 13)) as bigint) as rank from events where event_type <> 'purchase') select event_id from r order by rank, event_id limit (select cast(floor(count(*) * 5e-1) as bigint) from events where event_type = 'purchase')")
def synthetic_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic rows by lowest hash, at most half as many as observed ones."""
    events = table(spark, sf_dir, "events")
    n = events.where("event_type = 'purchase'").count()
    return frontier.capped_sample(events.where("event_type <> 'purchase'").select("event_id"), "event_id", n)


@query("with s as (select event_id as parent, count(*) over (partition by event_id) as n, user_id, k from events, range(2) r(k) where k = 0 or event_id % 90 = 0) select distinct parent, case when parent % 70 = 0 then 'missing' when n > 1 then 'repeated' else 'differs' end as fault from s where parent % 70 = 0 or n > 1 or parent % 50 = 0")
def parents_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of synthetic rows' lineage: missing, repeated and differing parents are planted."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    made_up = events.select(F.col("event_id").alias("parent"), F.when(F.col("event_id") % 50 == 0, F.col("user_id") + 1).otherwise(F.col("user_id")).alias("user_id"), "event_type")
    made_up = made_up.unionByName(made_up.where("parent % 90 = 0"))
    return views.parent_faults(made_up, events.where("event_id % 70 <> 0"), "parent", "event_id", ["user_id", "event_type"])


@query(f"with c as (select split_no, step, event_id % 97 as x, event_id % 89 as y from {S} s), f as (select split_no, x, y, min(step) as step from c group by all), n as (select split_no, step, count(*) as n_new from f group by 1, 2), k as (select distinct split_no, step from c) select k.split_no, k.step, coalesce(n_new, 0) as n_new, cast(sum(coalesce(n_new, 0)) over (partition by k.split_no order by k.step) as bigint) as n_seen from k left join n using (split_no, step)")
def cells_cumulated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct cells up to each step, from first steps."""
    c = adapters.derived(spark, sf_dir, "scores").selectExpr("split_no", "step", "event_id % 97 as x", "event_id % 89 as y")
    return frontier.cumulative(c, "split_no", "step", c)
