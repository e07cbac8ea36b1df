"""Queries of one-step transitions, incidents, weather completeness and releases, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspan.functions import grid
from cinderspan.operators import frontier, incidents, ledger, release
from cinderspan.plans.catalog import D_BINS, D_CELLS, D_GATE, _positives, _selected, over_selected, query, rounded
from cinderspan.session import table
from cinderspan.sources import adapters

# A scenario is a day. Its state: brightness as intensity (305 to 367 K, clipped) and an age by the last product seen.
STATE = f"""select cast(acquired_at as date) as scenario, x, y, max(least(greatest((bright_ti4 - 305) / {grid.num(62)}, {grid.num(0)}), {grid.num(1)})) as intensity,
  cast(max(case when event_type = 'view' then 1 else 0 end) as int) as age_steps from {{located}} l group by 1, 2, 3"""
BURNED = "select distinct cast(acquired_at + interval 24 hours as date) as scenario, x, y from {located} l where event_type = 'purchase'"
PROBABILITY = f"abs(x * 73 + y * 151) % 997 / {grid.num(997)}"
D_STATE, D_BURNED = (q.replace("{located}", adapters.located_oracle()) for q in (STATE, BURNED))
D_FRONTIER = f"""state as ({D_STATE}), gone as ({D_BURNED}),
near as (select scenario, cast(x + dx as int) as x, cast(y + dy as int) as y, max(intensity) as neighbour_intensity, count(*) as active_neighbours
  from state, range(-1, 2) a(dx), range(-1, 2) b(dy) where dx <> 0 or dy <> 0 group by 1, 2, 3),
front as (select n.* from near n anti join (select scenario, x, y from state union all select scenario, x, y from gone) t on n.scenario = t.scenario and n.x = t.x and n.y = t.y)"""
D_LIT = f"""lit as (select f.* exclude (place) from (select *, row_number() over (partition by scenario order by {PROBABILITY} desc, x, y) as place from front where {PROBABILITY} >= 5e-2) f
  join (select scenario, count(*) as n from state group by 1) s using (scenario) where place <= least(128, ceil(n / 2e0)))"""


def _state(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    located = adapters.located(spark, sf_dir)
    return tuple(spark.sql(q, located=located) for q in (STATE, BURNED))


def _frontier(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    state, burned = _state(spark, sf_dir)
    return state, frontier.frontier_candidates(state, burned)


@query(f"with {D_FRONTIER} select scenario, x, y, round(neighbour_intensity, 6) as neighbour_intensity, active_neighbours from front")
def frontier_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells next to active ones that are neither active nor burned."""
    return rounded(_frontier(spark, sf_dir)[1], "neighbour_intensity")


@query(f"with {D_FRONTIER}, {D_LIT} select scenario, x, y, round({PROBABILITY}, 6) as probability from lit")
def growth_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The likeliest new cells of every scenario, within its growth limit."""
    state, front = _frontier(spark, sf_dir)
    lit = frontier.capped_ignitions(front.withColumn("probability", F.expr(PROBABILITY)), state)
    return rounded(lit.select("scenario", "x", "y", "probability"), "probability")


@query(
    f"""with {D_FRONTIER}, {D_LIT}, stepped as (select scenario, x, y, intensity, age_steps + 1 as age_steps from state union all select scenario, x, y, neighbour_intensity * 85e-2, 0 from lit)
    select scenario, x, y, round(intensity, 6) as intensity, age_steps, case when age_steps < 2 then 'active' else 'burned' end as status from stepped"""
)
def state_advanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every scenario's state one step later."""
    state, front = _frontier(spark, sf_dir)
    lit = frontier.capped_ignitions(front.withColumn("probability", F.expr(PROBABILITY)), state)
    return rounded(frontier.advance_state(state, lit), "intensity")


@query(
    f"""with {D_FRONTIER}, pairs as (select coalesce(s.scenario, f.scenario) as scenario, coalesce(s.x, f.x) as x, coalesce(s.y, f.y) as y, s.intensity as o, f.neighbour_intensity as p
      from state s full join front f on s.scenario = f.scenario and s.x = f.x and s.y = f.y),
    picked as (select *, substr(sha256(concat('mix:', cast(scenario as varchar), ':', {grid.cell_id('x', 'y')})), 1, 13) < '4000000000000' as predicted from pairs)
    select scenario, x, y, predicted, round(case when predicted then p else o end, 6) as intensity from picked where (case when predicted then p else o end) is not null"""
)
def state_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed state and frontier mixed by hash: a quarter of the cells is taken from the frontier."""
    state, front = _frontier(spark, sf_dir)
    return rounded(frontier.state_mix(state, front.withColumnRenamed("neighbour_intensity", "intensity"), 0.25), "intensity")


@query(
    f"""with {D_CELLS}, near as (select p.snapshot, p.x, p.y, d.detection_id from pos p join located d on d.x between p.x - 2 and p.x + 2 and d.y between p.y - 2 and p.y + 2 where {D_GATE}),
    ids as (select snapshot, x, y, list_sort(list(distinct detection_id)) as ids from near group by 1, 2, 3)
    select snapshot, x, y, len(ids) as n_seeds, array_to_string(ids[1:128], ' ') as seeds, len(ids) > 128 as truncated, sha256(array_to_string(ids, chr(31))) as seeds_sha256 from ids"""
)
def seed_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detections behind every positive cell."""
    found = frontier.seed_lineage(_positives(spark, sf_dir), adapters.located(spark, sf_dir))
    return found.withColumn("seeds", F.array_join("seeds", " "))


@query(over_selected("seed_lineage"))
def seed_lineage_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detections behind every selected candidate, positives and proxies alike."""
    found = frontier.seed_lineage(_selected(spark, sf_dir), adapters.located(spark, sf_dir))
    return found.withColumn("seeds", F.array_join("seeds", " "))


_IDS = "case event_id % 4 when 0 then cast(user_id as {S}) when 1 then concat(cast(user_id as {S}), '.0') when 2 then concat(cast(user_id as {S}), '.5') else concat('-', cast(user_id + 1 as {S})) end as fire_id, case user_id % 3 when 0 then 'Canada' when 1 then 'CONUS' else 'Alaska' end as region"
_N = "try_cast(trim(fire_id) as decimal(38, 6))"


@query(
    f"""with k as (select event_id, cast(ts as timestamp) as t, {_IDS.replace('{S}', 'varchar')} from events)
    select event_id, case when {_N} >= 0 and {_N} = floor({_N}) and region in ('CONUS', 'Canada') then concat(region, ':', year(t), ':', cast(cast({_N} as decimal(32, 0)) as varchar)) end as incident_key from k"""
)
def incident_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoped fire keys; ids that aren't whole numbers, and other regions, have none."""
    k = spark.sql(f"select event_id, cast(ts as timestamp) as t, {_IDS.replace('{S}', 'string')} from {{e}}", e=table(spark, sf_dir, "events"))
    return k.select("event_id", incidents.incident_key("region", "fire_id", "t").alias("incident_key"))


def _duck_fraction(text: str) -> str:
    return f"(cast(concat('0x', substr(sha256({text}), 1, 13)) as bigint) / {grid.num(16.0**13)})"


_HALO = ", ".join(grid.region_key(f"(x + {dx})", f"(y + {dy})", 100) for dx in (-1, 0, 1) for dy in (-1, 0, 1))


@query(
    f"""with r as (select fire_id, acquired_at, unnest(list_distinct([{_HALO}])) as k from {adapters.located_oracle()} l),
    g as (select fire_id, max(acquired_at) as last_at, bool_or({_duck_fraction("concat('split:region:', k)")} < 2e-1) as touches_held_region from r group by 1),
    n as (select fire_id, count(*) as n_rows from {adapters.oracle('detections')} d group by 1)
    select fire_id, n_rows, touches_held_region, last_at >= timestamp '2024-01-30 12:00:00' as reaches_later_period,
    case when last_at >= timestamp '2024-01-30 12:00:00' then 'later_time' when touches_held_region then 'held_region'
      when {_duck_fraction("concat('split:incident:', cast(fire_id as varchar))")} < 2e-1 then 'held_incident'
      when {_duck_fraction("concat('split:incident:', cast(fire_id as varchar))")} < 32e-2 then 'calibration' else 'train' end as incident_split from g join n using (fire_id)"""
)
def incident_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One split per fire, with held regions of 100 cells."""
    rows = adapters.located(spark, sf_dir)
    return incidents.assign_splits(rows, "fire_id", "acquired_at", "2024-01-30 12:00:00", cells=100).drop("last_at")


@query(
    f"""with b as ({D_BINS}), i as (select *, t - row_number() over (partition by fire_id order by t) * interval 12 hours as island from b),
    runs as (select fire_id, island, min(t) as start, count(*) as n_times from i group by 1, 2 having count(*) >= 3)
    select fire_id, min(start) as start, arg_min(n_times, start) as n_times from runs group by 1"""
)
def first_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per fire the first run of three half-days or more without a gap."""
    d = adapters.derived(spark, sf_dir, "detections").select("fire_id", F.window("acquired_at", "12 hours").start.alias("t"))
    return incidents.first_run(ledger.gap_sequences(d, ["fire_id"], "t"), ["fire_id"], "t", 3)


_MEASURED = """select l_partkey % 30 as tile, cast(date_trunc('month', l_shipdate) as date) as month, concat('v', cast(l_suppkey % 5 as {S})) as variable, l_extendedprice as value, l_orderkey * 10 + l_linenumber as seq from lineitem"""
_EXAMPLES = "select o_orderkey as example_id, o_custkey % 30 as tile, cast(date_trunc('month', o_orderdate) as date) as month from orders"
_VARIABLES = [f"v{k}" for k in range(5)]
D_WEATHER = f"m as (select tile, month, variable, arg_max(value, seq) as value from ({_MEASURED.replace('{S}', 'varchar')}) group by 1, 2, 3), e as ({_EXAMPLES})"


def _weather(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    measured = spark.sql(_MEASURED.replace("{S}", "string").replace("from lineitem", "from {t}"), t=table(spark, sf_dir, "lineitem"))
    examples = spark.sql(_EXAMPLES.replace("from orders", "from {t}"), t=table(spark, sf_dir, "orders"))
    return examples, ledger.latest_by(measured, ["tile", "month", "variable"], ["seq"])


@query(f"with {D_WEATHER}, v as (select concat('v', k) as variable from range(5) r(k)) select w.example_id, w.tile, w.month, w.variable from (select * from e, v) w anti join m on w.tile = m.tile and w.month = m.month and w.variable = m.variable")
def missing_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Examples with the required variables that their tile and month lack."""
    return incidents.missing_weather(*_weather(spark, sf_dir), ["tile", "month"], _VARIABLES)


_U, _V = grid.wind_uv("v0", "v1")


@query(
    f"""with {D_WEATHER}, w as (select tile, month, {', '.join(f"max(value) filter (variable = '{v}') as {v}" for v in _VARIABLES)} from m group by 1, 2)
    select example_id, {', '.join(f'round({v}, 4) as {v}' for v in _VARIABLES)}, round({_U}, 4) as wind_u, round({_V}, 4) as wind_v from e join w using (tile, month) where {' and '.join(f'{v} is not null' for v in _VARIABLES)}"""
)
def weather_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Examples with all five variables of their tile and month, and the wind's components."""
    met = incidents.join_weather(*_weather(spark, sf_dir), ["tile", "month"], _VARIABLES)
    return rounded(met.selectExpr("example_id", *_VARIABLES, f"{_U} as wind_u", f"{_V} as wind_v"), *_VARIABLES, "wind_u", "wind_v", digits=4)


D_HORIZON = f"""with s as (select *, event_id % 10 <> 3 as has, case when event_id % 10 <> 3 then p else 0 end as q from {adapters.oracle('scores')} s0),
t as (select split_no, step, count(*) filter (y = 1 and q >= 5e-1) as tp, count(*) filter (y = 0 and q >= 5e-1) as fp, count(*) filter (y = 1 and q < 5e-1) as fn, count(*) filter (y = 0 and q < 5e-1) as tn,
  avg((y - q) * (y - q)) as brier, avg(case when has then 1e0 else 0e0 end) as coverage from s group by 1, 2)"""


def _horizons(spark: SparkSession, sf_dir: str, factor: float = 1.0) -> DataFrame:
    scores = adapters.derived(spark, sf_dir, "scores")
    predicted = scores.where("event_id % 10 <> 3").select("event_id", (F.col("p") * factor).alias("probability"), (F.col("p") * factor >= 0.5).alias("will_ignite"))
    return release.score_domain(scores.select("event_id", "y", "split_no", "step"), predicted, ["event_id"], ["split_no", "step"])


@query(f"{D_HORIZON} select split_no, step, tp, fp, fn, tn, round(brier, 6) as brier, round(coverage, 6) as coverage, abs(fp - fn) as area_error from t")
def horizon_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores per split and step over the whole domain, missing predictions as zero."""
    return rounded(_horizons(spark, sf_dir), "brier", "coverage")


@query(
    f"""{D_HORIZON}, s2 as (select *, case when event_id % 10 <> 3 then p * 5e-1 else 0 end as q2 from {adapters.oracle('scores')} s0),
    t2 as (select split_no, step, avg((y - q2) * (y - q2)) as brier, count(*) filter (y = 1 and q2 >= 5e-1) as tp from s2 group by 1, 2),
    m as (select split_no, step, 'brier' as metric, t.brier as a, t2.brier as b from t join t2 using (split_no, step) union all select split_no, step, 'tp', t.tp, t2.tp from t join t2 using (split_no, step))
    select split_no, step, metric, round(a, 6) as before, round(b, 6) as after, round(b - a, 6) as change, case when metric = 'tp' then b < a else b > a end as regressed from m"""
)
def runs_compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores against a run with halved probabilities."""
    met = release.compare_runs(_horizons(spark, sf_dir), _horizons(spark, sf_dir, 0.5), ["split_no", "step"], {"brier": False, "tp": True})
    return rounded(met, "before", "after", "change")


_BYTES = "select coalesce(source, 'other') as category, octet_length(encode(coalesce(text, ''), 'utf-8')) as bytes from documents"


@query(
    """with f as (select coalesce(source, 'other') as category, octet_length(encode(coalesce(text, ''))) as bytes from documents),
    u as (select category, sum(bytes) as used, count(*) as n_files from f group by 1 union all select 'whole-data', sum(bytes), count(*) from f),
    c as (select category, case when category = 'whole-data' then 20000000000 else 2000000000 + 1000 * length(category) end as cap from u)
    select u.category, cast(u.used as bigint) as used, n_files, cap, cast(cap - u.used as bigint) as remaining from u join c using (category)"""
)
def storage_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of text per source and in all, against their caps."""
    files = spark.sql(_BYTES.replace("from documents", "from {t}"), t=table(spark, sf_dir, "documents"))
    caps = files.select("category").distinct().select("category", (2_000_000_000 + 1000 * F.length("category")).cast("bigint").alias("cap"))
    return release.storage_usage(files, caps, 20_000_000_000)


_Q = """case when regexp_matches({c}, '[",\\r\\n]') then '"' || replace({c}, '"', '""') || '"' else {c} end"""


@query("select concat_ws(',', " + ", ".join(_Q.replace("{c}", f"coalesce(cast({c} as varchar), '')") for c in ("html", "page_id", "url")) + ") as line from pages")
def canonical_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as canonical CSV lines."""
    return release.canonical_csv(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
