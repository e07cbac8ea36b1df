"""Completed views, revisions, captures and releases: what is read, and whether it may be."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspan.operators.evaluate import content_digest
from cinderspan.operators.ledger import latest_by
from cinderspan.operators.records import require


def publish(spark: SparkSession, df: DataFrame, folder: str, build: str, kind: str, version: str, partition: list[str], manifests: str, **counts: Column) -> None:
    """Write a build to a folder of its own and, after all of it, append its one manifest row.

    The row is the commit: readers go by manifests, so a build that fails is never seen.
    """
    path = f"{folder}/{kind}/{build}"
    df.write.partitionBy(*partition).parquet(path)
    written = spark.read.parquet(path)
    row = content_digest(written.select(*df.columns)).select(
        F.lit(kind).alias("kind"), F.lit(version).alias("build_version"), F.lit(build).alias("build_id"), F.current_timestamp().alias("completed_at"), F.array(F.lit(path)).alias("paths"), F.col("n").alias("n_rows"), "digest"
    )
    if counts:
        row = row.crossJoin(written.agg(F.struct(*(c.alias(k) for k, c in counts.items())).alias("counts")))
    row.write.mode("append").parquet(manifests)


def newest_manifest(manifests: DataFrame, kind: str, version: str) -> DataFrame:
    """The newest manifest of a kind and build version, by completion and id: one row or none."""
    return latest_by(manifests.where((F.col("kind") == kind) & (F.col("build_version") == version)), ["kind"], ["completed_at", "build_id"])


def read_view(spark: SparkSession, manifests: DataFrame, kind: str, version: str, key: str) -> DataFrame:
    """Exactly the paths of the newest manifest; a repeated ``key`` or another row count stops the read."""
    row = newest_manifest(manifests, kind, version).first()
    if row is None:
        raise ValueError(f"no completed {kind} of version {version}")
    df = spark.read.parquet(*row["paths"])
    held = df.groupBy(key).agg(F.count("*").alias("n")).agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    if (held["n"] or 0) != row["n_rows"] or (held["most"] or 1) > 1:
        raise ValueError(f"{kind} holds {held['n']} rows for {row['n_rows']}, at most {held['most']} of one {key}")
    return df


def select_revision(entries: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Files of the newest complete entry that names an artifact, per key; later partial entries don't displace it.

    A key without any such entry keeps all its files.
    """
    named = entries.where((F.col("status") == "complete") & F.col("artifact_id").isNotNull())
    newest = latest_by(named.select(key, "recorded_at", "append_order", F.col("artifact_id").alias("_chosen")), [key], ["recorded_at", "append_order"])
    met = files.join(newest.select(key, "_chosen"), key, "left")
    return met.where("_chosen is null or artifact_id = _chosen").drop("_chosen")


def select_capture(queries: DataFrame, first: str | None = None, last: str | None = None, captured_at: str | None = None) -> DataFrame:
    """The capture whose query windows (``start_at, end_at``) meet the dates most often; ties go to the newest.

    A missing date leaves its side open. A named ``captured_at`` is taken as it is; where there is none of that time, the
    error lists the newest hundred. A window that doesn't end after it starts stops the job.
    """
    checked = require(queries, {"window ends after its start": F.col("end_at") > F.col("start_at")})
    meets = F.lit(True)
    if last is not None:
        meets = meets & (F.col("start_at") < F.lit(last).cast("timestamp") + F.expr("interval 1 day"))
    if first is not None:
        meets = meets & (F.col("end_at") > F.lit(first).cast("timestamp"))
    found = checked.groupBy("captured_at").agg(F.count_distinct(F.when(meets, F.struct("start_at", "end_at"))).alias("n_windows"))
    if captured_at is None:
        return found.agg(F.max(F.struct("n_windows", "captured_at")).alias("r")).where("r is not null").select("r.captured_at", "r.n_windows")
    named = found.where(F.col("captured_at") == F.lit(captured_at).cast("timestamp"))
    if named.isEmpty():
        known = found.select(F.date_format("captured_at", "yyyy-MM-dd HH:mm:ss").alias("t")).orderBy(F.desc("t")).limit(100).collect()
        raise ValueError(f"no capture at {captured_at}; there are: {', '.join(r['t'] for r in reversed(known))}")
    return named


def capture_artifacts(manifests: DataFrame, capture: DataFrame) -> DataFrame:
    """Artifacts of a capture, each content once: of manifests (``captured_at, content_sha256, manifest_path``) with one content the first by path."""
    own = manifests.join(F.broadcast(capture.select("captured_at")), "captured_at", "left_semi")  # one row
    return least_by(own, ["content_sha256"], "manifest_path")


def least_by(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of each key with the least ``order``: one map-side combined aggregate."""
    rest = [c for c in df.columns if c not in keys]
    least = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_r"))
    return least.select(*keys, *(F.col(f"_r.{c}").alias(c) for c in rest))


def merge_faults(builds: DataFrame) -> DataFrame:
    """Why builds (``build_id, policy, start_on, end_on``) can't be one: another policy, a gap or an overlap before it.

    Builds are few, one row each.
    """
    order = "over (order by start_on, build_id)"
    seen = builds.select("*", F.expr(f"lag(end_on) {order}").alias("before"), F.expr("min(policy) over ()").alias("least"))
    fault = F.when(F.col("policy") != F.col("least"), "policy").when(F.col("start_on") > F.date_add("before", 1), "gap").when(F.col("start_on") <= F.col("before"), "overlap")
    return seen.select("build_id", fault.alias("fault")).where("fault is not null")


def jsonl(df: DataFrame) -> DataFrame:
    """Rows as canonical JSON lines: sorted keys, nulls kept, numbers that are none as null."""
    safe = [F.when(F.isnan(f.name) | (F.abs(f.name) == float("inf")), None).otherwise(F.col(f.name)).alias(f.name) if f.dataType.typeName() in ("double", "float") else F.col(f"`{f.name}`") for f in sorted(df.schema.fields, key=lambda f: f.name)]
    return df.select(F.to_json(F.struct(*safe), {"ignoreNullFields": "false"}).alias("line"))


def inventory(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Files of a release by their path within it, with size and sha256, read by Spark."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return files.select(F.substring_index("path", f"/{folder.rstrip('/').rpartition('/')[2]}/", -1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def verification_faults(found: DataFrame, listed: DataFrame) -> DataFrame:
    """Files that a release lists and lacks, holds unlisted, or holds changed."""
    met = listed.select("name", F.col("sha256").alias("a")).join(found.select("name", F.col("sha256").alias("b")), "name", "full")
    fault = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "unlisted").when(F.col("a") != F.col("b"), "changed")
    return met.select("name", fault.alias("fault")).where("fault is not null")


def equivalent(a: DataFrame, b: DataFrame) -> DataFrame:
    """Whether two tables hold the same rows in any order: counts, digests, and the verdict (one row)."""
    same_columns = sorted(a.columns) == sorted(b.columns)
    met = content_digest(a).toDF("n_a", "digest_a").crossJoin(content_digest(b).toDF("n_b", "digest_b"))
    return met.withColumn("same", F.lit(same_columns) & (F.col("n_a") == F.col("n_b")) & F.col("digest_a").eqNullSafe(F.col("digest_b")))


def admission(usage: DataFrame, wanted: DataFrame) -> DataFrame:
    """Whether ``wanted`` bytes per category fit what is left of it and of the whole: ``category, wanted, admitted, reason``."""
    whole = usage.where("category = 'whole-data'").agg(F.max("remaining").alias("_whole"))
    met = wanted.join(usage.select("category", "remaining"), "category", "left").crossJoin(F.broadcast(whole))  # one row
    reason = F.when(F.col("remaining").isNull(), "unknown-category").when(F.col("wanted") > F.col("remaining"), "category-cap").when(F.col("wanted") > F.col("_whole"), "total-cap").otherwise("fits")
    return met.select("category", "wanted", (reason == "fits").alias("admitted"), reason.alias("reason"))


def lineage_union(df: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Sorted distinct ids over several array columns, per key: exploded and made distinct before they are gathered."""
    ids = df.select(*key, F.explode(F.flatten(F.array(*(F.coalesce(c, F.array().cast("array<string>")) for c in columns)))).alias("id")).distinct()
    return ids.groupBy(*key).agg(F.array_sort(F.collect_list("id")).alias("ids"), F.count("*").alias("n_ids"))


def parent_faults(synthetic: DataFrame, observed: DataFrame, parent: str, key: str, same: list[str]) -> DataFrame:
    """Synthetic rows whose parent is missing, repeated, or differs in a column: ``parent, fault``."""
    rows = synthetic.groupBy(parent).agg(F.count("*").alias("_n"), *(F.min(c).alias(c) for c in same))
    met = rows.join(observed.select(F.col(key).alias(parent), F.lit(True).alias("_known"), *(F.col(c).alias(f"_o_{c}") for c in same)), parent, "left")
    differs = F.lit(False)
    for c in same:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    fault = F.when(F.col("_known").isNull(), "missing").when(F.col("_n") > 1, "repeated").when(differs, "differs")
    return met.select(parent, fault.alias("fault")).where("fault is not null")


def checked_mix(df: DataFrame, weight: str, key: str) -> DataFrame:
    """A mixed view of observed and synthetic rows, unless a weight isn't in (0, 1] or an id is missing."""
    return require(df, {"weight": (F.col(weight) > 0) & (F.col(weight) <= 1), "id": F.col(key).isNotNull()})


def mix_faults(observed: DataFrame, synthetic: DataFrame, examples: DataFrame, weight: float, most: float) -> DataFrame:
    """What keeps observed references and synthetic rows from being one training view: ``fault, n`` for each fault found.

    References (``example_id, incident_group_id, sample_weight``) are distinct, weigh 1 and name training examples of their group
    whose centre has no detection. Synthetic rows weigh ``weight`` and are at most ``most`` of the references' number, rounded down.
    """
    known = examples.select("example_id", F.col("incident_group_id").alias("_group"), F.col("incident_split").alias("_split"), F.col("firms_center_has_detection").alias("_centre"), F.lit(True).alias("_known"))
    refs = observed.groupBy("example_id").agg(F.count("*").alias("_n"), F.min("incident_group_id").alias("_own"), F.count_if(~F.col("sample_weight").eqNullSafe(F.lit(1.0))).alias("_off"))
    met = refs.join(known, "example_id", "left")
    there = F.col("_known").isNotNull()
    counted = met.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("observed"),
        F.count_if(F.col("_n") > 1).alias("repeated"),
        F.coalesce(F.sum("_off"), F.lit(0)).alias("observed-weight"),
        F.count_if(~there).alias("unknown"),
        F.count_if(there & ~F.col("_split").eqNullSafe(F.lit("train"))).alias("split"),
        F.count_if(there & ~F.col("_centre").eqNullSafe(F.lit(0))).alias("centre"),
        F.count_if(there & ~F.col("_own").eqNullSafe(F.col("_group"))).alias("group"),
    )
    made = synthetic.agg(F.count("*").alias("synthetic"), F.count_if(~F.col("sample_weight").eqNullSafe(F.lit(weight))).alias("synthetic-weight"))
    one = counted.crossJoin(made).withColumn("too-many", F.greatest(F.lit(0), F.col("synthetic") - F.floor(F.col("observed") * most)))  # one row each
    names = ("repeated", "observed-weight", "unknown", "split", "centre", "group", "synthetic-weight", "too-many")
    pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("fault"), F.col(f"`{k}`").cast("bigint").alias("n")) for k in names))).alias("p")
    return one.select(pairs).select("p.*").where("n > 0")


def mixed_view(observed: DataFrame, synthetic: DataFrame, examples: DataFrame, weight: float, most: float) -> DataFrame:
    """The examples that references name and the synthetic rows, with what either lacks as null; faults (see ``mix_faults``) are an error."""
    faults = mix_faults(observed, synthetic, examples, weight, most).collect()  # eight rows at most
    if faults:
        raise ValueError("mixed view refused: " + ", ".join(f"{r['fault']} {r['n']}" for r in faults))
    own = examples.join(observed.select("example_id", "sample_weight"), "example_id")
    return checked_mix(own.unionByName(synthetic, allowMissingColumns=True), "sample_weight", "example_id")


def write_ordered(df: DataFrame, path: str, *order: str, files: int | None = None) -> None:
    """Parquet files whose names and rows follow ``order``, each written by a task of its own range; ``files`` of them, or as many as Spark finds fit."""
    df.repartitionByRange(*([] if files is None else [files]), *order).sortWithinPartitions(*order).write.parquet(path)
