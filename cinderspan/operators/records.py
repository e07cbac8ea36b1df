"""Normalized records and their checks: detections, perimeters, ids, contracts.

A check never drops a row. ``violations`` lists what breaks a rule; ``require`` stops the job at the first such
row. A refusal is a filter that passes every good row and fails on a bad one: no choice of columns removes it, so
``count()`` and a select of any column fail as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Regions whose perimeters are aligned in time.
REGIONS = ("CONUS", "Canada")


def read_detections_csv(spark: SparkSession, path: str) -> DataFrame:
    """A detection CSV with a header, every column as text; a file of a header alone is a valid empty table."""
    return spark.read.csv(path, header=True, inferSchema=False, mode="FAILFAST", encoding="UTF-8")


def in_dates(df: DataFrame, column: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Rows of a partition column's dates, both ends included; a filter on it prunes folders."""
    for bound, test in ((first, F.col(column) >= F.lit(first).cast("date")), (last, F.col(column) <= F.lit(last).cast("date"))):
        df = df.where(test) if bound else df
    return df


def in_window_of(detections: DataFrame, labels: DataFrame, column: str = "acq_date", lookback_h: int = 24, lag_h: int = 3) -> DataFrame:
    """Detections of the dates that a batch of labels (``anchor_at``) can see: first cutoff less lookback to last less lag.

    The two bounds are read from the labels first (one row), so they are literals in the plan and the scan lists only
    their folders. A batch without labels sees nothing.
    """
    ends = labels.agg(F.to_date(F.min("anchor_at") - F.expr(f"interval {lookback_h} hours")).alias("a"), F.to_date(F.max("anchor_at") - F.expr(f"interval {lag_h} hours")).alias("b")).first()
    if ends["a"] is None:
        return detections.where(F.lit(False))
    return in_dates(detections, column, str(ends["a"]), str(ends["b"]))


def hhmm(date: str, time: str) -> Column:
    """UTC time of a date and one to four digits HHMM (``'40'`` is 00:40); null where either is none."""
    digits = f"trim(cast({time} as string))"
    padded = f"lpad({digits}, 4, '0')"
    text = f"concat({date}, ' ', substr({padded}, 1, 2), ':', substr({padded}, 3, 2))"
    return F.expr(f"case when {digits} rlike '^[0-9]{{1,4}}$' then try_to_timestamp({text}, 'yyyy-MM-dd HH:mm') end")


def stable_id(namespace: str, json: Column) -> Column:
    return F.concat(F.lit(f"{namespace}:"), F.sha2(json, 256))


def canonical_json(names: list[str]) -> Column:
    """Columns as one compact JSON object with sorted keys, nulls kept."""
    return F.to_json(F.struct(*(F.col(f"`{n}`") for n in sorted(names))), {"ignoreNullFields": "false"})


def json_safe(value: str) -> Column:
    """A number without NaN and infinities, which become null."""
    return F.expr(f"case when isnan({value}) or abs({value}) = double('infinity') then null else {value} end")


def platform_identity(*candidates: Column) -> Column:
    """The first text that isn't blank, in lower case, else ``unknown``."""
    return F.lower(F.coalesce(*(F.when(F.trim(c) != "", F.trim(c)) for c in candidates), F.lit("unknown")))


def normalize_detections(raw: DataFrame, provider: str, product: Column, minimum: float | None = 305.0) -> DataFrame:
    """Typed detections of raw text rows: stable ids, UTC time, finite coordinates in range, threshold as a flag.

    All raw fields stay in ``raw_source_fields`` and make the id; what was fetched when doesn't. A row
    whose core fields are no numbers in range stops the job.
    """
    fields = raw.columns
    source = F.to_json(F.struct(product.alias("product"), F.lit(provider).alias("provider")))
    number = lambda c: F.expr(f"try_cast({c} as double)")
    typed = raw.select(
        F.lit("firms_detection").alias("record_type"),
        stable_id("firms-source", source).alias("source_id"),
        hhmm("acq_date", "acq_time").alias("acquired_at"),
        *(number(c).alias(c) for c in ("latitude", "longitude", "bright_ti4")),
        F.struct(*(F.col(f"`{c}`").cast("string").alias(c) for c in sorted(fields))).alias("raw_source_fields"),
        product.alias("product"),
    )
    identity = F.to_json(F.struct("raw_source_fields", "source_id"), {"ignoreNullFields": "false"})
    typed = typed.withColumn("detection_id", stable_id("firms-detection", identity)).withColumn(
        "passes", F.lit(None).cast("boolean") if minimum is None else F.col("bright_ti4") >= minimum
    )
    return require(
        typed,
        {
            "acquired_at": F.col("acquired_at").isNotNull(),
            "latitude": F.col("latitude").between(-90, 90),
            "longitude": F.col("longitude").between(-180, 180),
            "bright_ti4": json_safe("bright_ti4").isNotNull(),
        },
    )


def utc_text(time: str) -> Column:
    """ISO text in UTC, without microseconds where they are zero."""
    return F.expr(f"date_format({time}, case when unix_micros({time}) % 1000000 = 0 then \"yyyy-MM-dd'T'HH:mm:ss'Z'\" else \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\" end)")


def example_id(cell: Column, anchor: str, horizon_s: int = 43_200) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit("1"), cell, utc_text(anchor), F.lit(str(horizon_s))), 256)


def cell_of_id(cell_id: str) -> Column:
    """``x, y`` of a cell id; null for any other id, those of tiles included."""
    part = lambda k: f"cast(regexp_extract({cell_id}, '^naea-1km:x=(-?[0-9]+):y=(-?[0-9]+)$', {k}) as int)"
    return F.expr(f"case when {cell_id} rlike '^naea-1km:x=-?[0-9]+:y=-?[0-9]+$' then struct({part(1)} as x, {part(2)} as y) end")


def normalize_perimeters(features: DataFrame) -> DataFrame:
    """Perimeter records of ``primarykey, region, fireid, t`` (epoch ms) and any other columns.

    The time is the key's last part; without a key it is ``t``. Both are kept and compared.
    """
    key = F.when(F.trim("primarykey") != "", F.trim("primarykey"))
    own = F.to_timestamp(F.trim(F.substring_index(key, "|", -1)))
    provider = F.expr("timestamp_millis(cast(t as bigint))")
    time = F.coalesce(own, provider)
    fallback = F.concat_ws("|", F.coalesce("region", F.lit("unknown-region")), F.col("fireid").cast("string"), utc_text("source_snapshot_time"))
    return (
        features.withColumns({"source_snapshot_time": time, "time_source": F.when(own.isNotNull(), "primarykey").otherwise("provider-t-fallback"), "t_matches": provider == time})
        .withColumn("source_record_id", F.coalesce(key, fallback))
        .withColumn("time_alignment_eligible", F.coalesce(F.col("region").isin(*REGIONS), F.lit(False)))
    )


def fingerprint(fields: Column, ignored: list[str]) -> Column:
    """Digest of a map of fields, in key order, without those that change between fetches."""
    kept = F.map_filter(fields, lambda k, _: ~k.isin(*ignored))
    return F.sha2(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(kept)))), 256)


def eligible_records(records: DataFrame, snapshot: Column | None = None) -> DataFrame:
    """Records of the aligned regions (and of one snapshot) that aren't marked as out of line."""
    kept = records.where(F.col("region").isin(*REGIONS) & F.coalesce(F.col("time_alignment_eligible"), F.lit(True)))
    return kept if snapshot is None else kept.where(F.col("source_snapshot_time") == snapshot)


def duplicate_report(records: DataFrame, snapshot: str, record: str, mark: str) -> DataFrame:
    """Per snapshot: records, repeats with one fingerprint, records with several, rows without an id."""
    rows = records.groupBy(snapshot, record).agg(F.count("*").alias("n"), (F.min(mark) != F.max(mark)).alias("differs"))
    known = F.col(record).isNotNull()
    return rows.groupBy(snapshot).agg(
        F.count_if(known).alias("n_records"), F.sum(F.when(known & ~F.col("differs"), F.col("n") - 1).otherwise(0)).alias("n_duplicates"),
        F.count_if(known & F.col("differs")).alias("n_conflicts"), F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("n_invalid"),
    )


def violations(df: DataFrame, rules: dict[str, Column], key: list[str]) -> DataFrame:
    """``key, rule`` for every rule that a row breaks; a rule that is null counts as broken."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())))
    return df.select(*key, F.explode(broken).alias("rule"))


def refuse(df: DataFrame, bad: Column, message: Column) -> DataFrame:
    """``df``; the job that reads it fails with ``message`` at a row for which ``bad`` holds or is null.

    Spark may test a bare ``is not null`` filter that stands before this one after it; a condition that depends on such a filter says so itself.
    """
    return df.where(F.when(~F.coalesce(bad, F.lit(True)), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def require(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``df``, unless a row breaks a rule: then the job that reads it fails and names the rule."""
    broken = F.lit(None).cast("string")
    for name, ok in reversed(list(rules.items())):
        broken = F.when(~F.coalesce(ok, F.lit(False)), F.lit(f"row breaks the rule {name}")).otherwise(broken)
    return refuse(df, broken.isNotNull(), broken)


def require_once(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """``df``, unless rows repeat their keys."""
    counted = df.withColumn("_n", F.count("*").over(Window.partitionBy(*keys)))
    return require(counted, {what: F.col("_n") == 1}).drop("_n")


def once_by_id(df: DataFrame, key: str) -> DataFrame:
    """One row for each id. Equal repeats count once; rows of one id that differ stop the job."""
    rest = [c for c in df.columns if c != key]
    ends = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("a"), F.max(F.struct(*rest)).alias("b"))
    same = refuse(ends, ~F.col("a").eqNullSafe(F.col("b")), F.concat(F.lit("rows of one id differ: "), F.col(key).cast("string")))
    return same.select(key, *(F.col(f"a.{c}").alias(c) for c in rest)).select(*df.columns)


def split_faults(df: DataFrame, time: str, split: str = "dataset_split") -> DataFrame:
    """Times of more than one split, and training times that aren't before every validation time."""
    times = df.groupBy(time).agg(F.bool_or(F.col(split) == "train").alias("train"), F.bool_or(F.col(split) == "validation").alias("validation"))
    first = F.broadcast(times.where("validation").agg(F.min(time).alias("_first")))
    found = times.crossJoin(first)  # one row
    return found.select(time, (F.col("train") & F.col("validation")).alias("mixed"), (F.col("train") & (F.col(time) >= F.col("_first"))).alias("late")).where("mixed or coalesce(late, false)").fillna(False, ["late"])


def isolation_faults(df: DataFrame, group: str, split: str) -> DataFrame:
    """Groups that stand in more than one split."""
    return df.groupBy(group).agg(F.count_distinct(split).alias("n_splits"), F.min(split).alias("first_split"), F.max(split).alias("last_split")).where("n_splits > 1")


def merge_report(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How keys meet in a merge that should be one to one: status and number of keys."""
    a, b = (d.groupBy(key).agg(F.count("*").alias(n)) for d, n in ((left, "l"), (right, "r")))
    status = F.when(F.col("l").isNull(), "right-only").when(F.col("r").isNull(), "left-only").when((F.col("l") > 1) | (F.col("r") > 1), "repeated").otherwise("matched")
    return a.join(b, key, "full").groupBy(status.alias("status")).agg(F.count("*").alias("n_keys"))


def merge_one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The merge, unless a key is missing on a side or repeated."""
    own = [c for c in right.columns if c != key]
    b = right.groupBy(key).agg(F.count("*").alias("_n"), *(F.first(c).alias(c) for c in own))
    a = left.groupBy(key).agg(F.count("*").alias("_m"), *(F.first(c).alias(c) for c in left.columns if c != key))
    met = a.join(b, key, "full")
    return require(met, {"one to one": (F.col("_n") == 1) & (F.col("_m") == 1)}).drop("_n", "_m")


def redact(text: Column) -> Column:
    """Secrets out of a text: values of named query parameters, bearer tokens, key segments of a path."""
    out = F.regexp_replace(text, r"(?i)([?&](?:map_key|api_?key|key|token|secret|password)=)[^&#\s]+", "$1REDACTED")
    out = F.regexp_replace(out, r"(?i)(bearer\s+)[A-Za-z0-9._~+/=-]+", "$1REDACTED")
    return F.regexp_replace(out, r"(/api/[a-z]+/csv/)[^/?#\s]+", "$1REDACTED")


def redact_map(fields: Column) -> Column:
    """A map whose secret keys lose their values, and whose other values are redacted as texts."""
    return F.transform_values(fields, lambda k, v: F.when(F.lower(k).rlike("key|token|secret|password|authorization"), F.lit("REDACTED")).otherwise(redact(v)))
