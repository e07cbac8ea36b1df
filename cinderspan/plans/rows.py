"""Queries of assembled rows, coverage ids, lineage, augmentation, payloads, plans as text and merged builds, with their SQL."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspan.functions import grid
from cinderspan.operators import assembly, fire, payloads
from cinderspan.plans.catalog import _SQL, _positives, query, rounded
from cinderspan.plans.records import duck, made
from cinderspan.plans.transitions import D_FRONTIER, D_LIT, PROBABILITY, _state
from cinderspan.session import shared_path, table
from cinderspan.sources import adapters


def d_utc(t: str) -> str:
    return f"case when epoch_us({t}) % 1000000 = 0 then strftime({t}, '%Y-%m-%dT%H:%M:%SZ') else strftime({t}, '%Y-%m-%dT%H:%M:%S.%fZ') end"


LAND = "select distinct x, y, abs(x * 7 + y) % 300 / 1e1 as slope_deg from {l} l where abs(x + y) % 3 <> 0"


@query(
    f"""with land as ({LAND.replace('{l}', adapters.located_oracle())}), s as ({_SQL['fire_state_features']})
    select s.x, s.y, s.anchor_at, sha256(concat_ws(chr(31), '1', {grid.cell_id('s.x', 's.y')}, {d_utc('s.anchor_at')}, '43200')) as example_id, {grid.cell_id('s.x', 's.y')} as cell_id, {d_utc('s.anchor_at')} as anchor_text, s.anchor_at + interval 12 hours as target_end_at,
      local_count, local_max, local_hours_since, slope_deg, case when slope_deg is null then 'outside-source' else 'available' end as terrain_status, 0 as weather_available, 'no-weather' as weather_input_policy, 'positive-only' as binary_training_status, 12 as prediction_horizon_hours
    from s left join land using (x, y)"""
)
def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assembled rows of all positive cells: identity, times, evidence, terrain where there is any, and what is missing."""
    located = adapters.located(spark, sf_dir)
    labels = _positives(spark, sf_dir).select("x", "y", "anchor_at").distinct()
    rows = assembly.training_rows(labels, fire.fire_state(labels, located), spark.sql(LAND, l=located), "v1")
    names = ("x", "y", "anchor_at", "example_id", "cell_id", "anchor_text", "target_end_at", "local_count", "local_max", "local_hours_since", "slope_deg", "terrain_status", "weather_available", "weather_input_policy", "binary_training_status", "prediction_horizon_hours")
    return rounded(rows.select(*names), "local_max", "local_hours_since")


@query(
    f"""select detection_id, concat_ws(':', 'firms', product, region, cast(cast(acquired_at as date) as varchar)) as firms_id, concat_ws(':', 'feds-nrt-primarykey-snapshot-observed', 'v1', region, {d_utc('acquired_at')}) as snapshot_id,
    concat_ws(':', 'feds-weak-labels', 'b1', region, {d_utc('acquired_at')}, 'local-solar', 'overlap=0.100000') as label_id from {adapters.oracle('detections')} d"""
)
def coverage_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the coverage that every detection's day, snapshot and label window expect."""
    from cinderspan.operators.records import utc_text

    d = adapters.derived(spark, sf_dir, "detections")
    return d.select(
        "detection_id",
        assembly.coverage_id("firms", F.col("product"), F.col("region"), F.to_date("acquired_at").cast("string")).alias("firms_id"),
        assembly.coverage_id("feds-nrt-primarykey-snapshot-observed", "v1", F.col("region"), utc_text("acquired_at")).alias("snapshot_id"),
        assembly.label_coverage_id("b1", "region", "acquired_at", "local-solar", 0.1).alias("label_id"),
    )


@query(
    f"""with near as (select cast(x + dx as int) as x, cast(y + dy as int) as y, acquired_at, detection_id, raw_artifact_id from {adapters.located_oracle()} l, range(-1, 2) a(dx), range(-1, 2) b(dy))
    select x, y, count(*) as source_detection_count, max(acquired_at) as latest_acquired_at, string_agg(distinct detection_id, ' ' order by detection_id) as source_detection_ids, string_agg(distinct raw_artifact_id, ' ' order by raw_artifact_id) as source_raw_artifact_ids from near group by 1, 2"""
)
def cell_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detections and artifacts behind every cell next to a detection."""
    found = assembly.cell_lineage(adapters.located(spark, sf_dir))
    return found.withColumns({c: F.array_join(c, " ") for c in ("source_detection_ids", "source_raw_artifact_ids")})


EXAMPLES = "select cast(acquired_at as date) as scenario, x, y, min(detection_id) as example_id, cast(max(case when event_type = 'purchase' then 1 else 0 end) as int) as target, cast(abs(x + y) % 2 as int) as flag from {l} l group by 1, 2, 3"
D_SECOND = f"""{D_FRONTIER}, {D_LIT}, ex as ({EXAMPLES.replace('{l}', adapters.located_oracle())}),
  stepped as (select scenario, x, y, intensity, age_steps + 1 as age_steps from state union all select scenario, x, y, neighbour_intensity * 85e-2, 0 from lit),
  act as (select *, 3 + 12 * age_steps as age_h, greatest(1, ceil(3 * intensity)) as detections from stepped where age_steps < 2), over_ as (select scenario, x, y from gone union select scenario, x, y from stepped where age_steps >= 2),
  around as (select scenario, cast(x + dx as int) as x, cast(y + dy as int) as y, intensity, age_h, detections, dx, dy from act, range(-1, 2) a(dx), range(-1, 2) b(dy)),
  second as (select distinct scenario, x, y from around n where (dx <> 0 or dy <> 0) and not exists (select 1 from act t where t.scenario = n.scenario and t.x = n.x and t.y = n.y) and not exists (select 1 from over_ t where t.scenario = n.scenario and t.x = n.x and t.y = n.y)),
  feats as (select scenario, x, y, sum(detections) as local_count, max(305 + 62 * intensity) as local_max, sum((305 + 62 * intensity) * detections) / sum(detections) as local_mean, min(age_h) as local_hours_since, count(*) as local_active_cells from around where age_h between 3 and 24 group by 1, 2, 3),
  pairs as (select distinct cast(s.scenario + 1 as date) as scenario from state s join ex on ex.scenario = s.scenario + 1),
  hist as (select * from ex where flag = 0 and scenario in (select scenario from pairs)), moved as (select cast(scenario + 1 as date) as scenario, x, y from second where scenario + 1 in (select scenario from pairs))"""


def _augmented(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    state, burned = _state(spark, sf_dir)
    examples = spark.sql(EXAMPLES, l=adapters.located(spark, sf_dir))
    return assembly.one_step_augmentation(state, burned, examples, F.expr(PROBABILITY), step="interval 1 day")


@query(
    f"""with {D_SECOND} select h.scenario, h.x, h.y, h.example_id, h.target, cast(coalesce(local_count, 0) as bigint) as local_count, round(local_max, 6) as local_max, round(local_mean, 6) as local_mean, local_hours_since, coalesce(local_active_cells, 0) as local_active_cells
    from hist h join moved m using (scenario, x, y) left join feats f on f.scenario = h.scenario - 1 and f.x = h.x and f.y = h.y"""
)
def augmented_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frontier rows of every day with the features that the predicted state of the day before renders."""
    rows, _ = _augmented(spark, sf_dir)
    out = rows.select("scenario", "x", "y", "example_id", "target", "local_count", "local_max", "local_mean", F.col("local_hours_since").cast("int").alias("local_hours_since"), "local_active_cells")
    return rounded(out, "local_max", "local_mean")


@query(
    f"""with {D_SECOND} select p.scenario, count(*) filter (m.x is not null and h.x is not null) as matched, count(*) filter (m.x is not null and target = 1) as matched_positives, count(*) filter (m.x is null and h.x is not null) as unreached,
    count(*) filter (m.x is null and target = 1) as unreached_positives, count(*) filter (m.x is not null and h.x is null) as outside
    from pairs p left join (select coalesce(m.scenario, h.scenario) as s, m.x as mx, h.x as hx, h.target from moved m full join hist h on m.scenario = h.scenario and m.x = h.x and m.y = h.y) j on j.s = p.scenario, lateral (select j.mx as x) m, lateral (select j.hx as x) h group by 1"""
)
def augmentation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the predicted frontier of each pair of days meets the next day's own."""
    return _augmented(spark, sf_dir)[1]


PAYLOADS = """select page_id, html, case page_id % 6 when 5 then 404 when 4 then 206 else 200 end as status_code, case page_id % 5 when 0 then 'SHA-256' when 1 then 'MD5' when 2 then 'CRC' when 3 then '' else 'sha1' end as checksum_algorithm,
  case when page_id % 7 = 3 then 'gzip' else '' end as content_encoding, case when page_id % 4 = 0 then 'many' when page_id % 4 = 1 then '12' else null end as content_length, case when page_id % 9 = 0 then '00' else null end as planted from pages"""
_D_PAYLOAD = f"(select *, case when page_id % 8 = 6 then encode('<html>') when page_id % 2 = 0 then '\\x43\\x44\\x46\\x01'::blob else '\\x89HDF\\x0D\\x0A\\x1A\\x0A'::blob end || encode(coalesce(html, '')) as payload from {duck(PAYLOADS)} p)"


@query(
    f"""with f as (select *, octet_length(payload) as n, coalesce(planted, case checksum_algorithm when 'SHA-256' then sha256(payload) when 'MD5' then upper(md5(payload)) when 'sha1' then sha1(payload) else '99' end) as checksum from {_D_PAYLOAD} q)
    select page_id, n as n_bytes, case when status_code > 299 then concat('HTTP ', status_code) when page_id % 8 = 6 then 'signature' when content_length = 'many' and content_encoding = '' then 'invalid-length' when content_length = '12' and content_encoding = '' and n <> 12 then 'length'
      when checksum_algorithm = 'CRC' then 'unknown-algorithm' when checksum_algorithm <> '' and planted is not null then 'checksum' end as fault from f"""
)
def payload_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first fault of every page's answer: status, signature, length, checksum. Faults are planted."""
    p = made(spark, sf_dir, PAYLOADS, "pages")
    head = F.when(F.col("page_id") % 8 == 6, F.lit("<html>").cast("binary")).when(F.col("page_id") % 2 == 0, F.unhex(F.lit("43444601"))).otherwise(F.unhex(F.lit("894844460D0A1A0A")))
    p = p.withColumn("payload", F.concat(head, F.coalesce("html", F.lit("")).cast("binary")))
    known = payloads.payload_facts(p).withColumn("checksum", F.coalesce("planted", F.when(F.col("checksum_algorithm") == "MD5", F.upper("digest")).otherwise(F.col("digest")), F.lit("99")))
    return known.select("page_id", "n_bytes", payloads.payload_fault().alias("fault"))


_RUN = "to_timestamp(run * 21600)::timestamp"


@query(
    f"""with p as ({_SQL['forecast_tile_plan']}) select 'gfs' as model, {d_utc(f'({_RUN})')} as model_run_at, concat('webmercator:x=', cast(tx as bigint), ':y=', cast(ty as bigint)) as tile_id, {d_utc(f'({_RUN} - interval 24 hours)')} as anchor_window_start, {d_utc(f'({_RUN} - interval 3 hours)')} as anchor_window_end,
    cast(n as varchar) as candidate_detection_count, printf('%.6f', max_bright) as max_bright_ti4, representative as representative_detection_id, printf('%.6f', score) as fire_evidence_score, case when reason = 'selected' then 'true' else 'false' end as selected,
    case when reason = 'selected' then cast(place as varchar) else '' end as selection_rank, case when reason = 'selected' then '' else reason end as non_admission_reason from p"""
)
def tile_plan_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tile plan as it is written, after a round trip by CSV whose columns and rows are checked."""
    plan = rounded(fire.tile_buckets(adapters.derived(spark, sf_dir, "detections")), "max_bright")
    text = assembly.tile_plan_text(plan, "gfs")
    path = shared_path(spark, "tile-plan")
    text.write.csv(path, header=True, emptyValue="", nullValue="")
    return assembly.read_release(spark, path, text.columns, spark.read.csv(path, header=True).count()).fillna("")


@query("select event_id, user_id, event_type, cast(n as bigint) as n_rows_merged from events, (select count(*) as n from events) c")
def builds_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events published as three builds of contiguous days and merged into one, with the manifest's count."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"))
    folder = shared_path(spark, "builds")
    ends = events.agg(F.min("day").alias("a"), F.max("day").alias("b")).first()
    cuts = [ends["a"], *(ends["a"] + (ends["b"] - ends["a"]) * k / 3 for k in (1, 2)), ends["b"]]
    parts = []
    for k in range(3):
        first = cuts[k] + timedelta(days=min(k, 1))
        part = events.where(F.col("day").between(F.lit(first), F.lit(cuts[k + 1])))
        part.write.parquet(f"{folder}/b{k}")
        parts.append((f"b{k}", "p1", first, cuts[k + 1], f"{folder}/b{k}", spark.read.parquet(f"{folder}/b{k}").count()))
    builds = spark.createDataFrame(parts, "build_id string, policy string, start_on date, end_on date, path string, n_rows long")
    rows, manifest = assembly.merged_builds(spark, builds, ["event_id"], str(ends["a"]), str(ends["b"]))
    return rows.select("event_id", "user_id", "event_type").crossJoin(F.broadcast(manifest.select(F.col("n_rows").alias("n_rows_merged"))))  # one row
