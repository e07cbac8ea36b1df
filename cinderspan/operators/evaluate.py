"""Calibration, ranking and confusion metrics, feature summaries, drift screens, rasters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderspan.operators.records import refuse


def calibration_bins(scores: DataFrame, key: list[str], bins: int = 10) -> DataFrame:
    """Fixed-width bins (the top one closed), empty ones included: n, mean probability, rate, gap."""
    binned = scores.withColumn("bin", F.least(F.floor(F.col("p") * bins), F.lit(bins - 1)).cast("int"))
    stats = binned.groupBy(*key, "bin").agg(F.count("*").alias("n"), F.avg("p").alias("mean_p"), F.avg("y").alias("rate"))
    frame = scores.select(*key).distinct().select(*key, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = frame.join(stats, [*key, "bin"], "left").fillna(0, ["n"])
    return out.withColumn("gap", F.abs(F.col("mean_p") - F.col("rate")))


def calibration_errors(scores: DataFrame, key: list[str], bins: int = 10) -> DataFrame:
    """Expected and maximum calibration error per key, over the bins that hold rows."""
    b = calibration_bins(scores, key, bins).where("n > 0")
    return b.groupBy(*key).agg((F.sum(F.col("n") * F.col("gap")) / F.sum("n")).alias("ece"), F.max("gap").alias("mce"), F.sum("n").alias("n"))


def running(counts: DataFrame, key: list[str], order: str, sums: list[str], width: float, descending: bool = False) -> DataFrame:
    """``counts`` with running sums ``run_<c>`` by ``order``, in two passes over buckets of ``width``.

    Bucket totals are a small table whose own running sums are the buckets' beginnings; within a bucket
    a window goes over that bucket alone. So no key needs one task.
    """
    k = ", ".join(key)
    way = "desc" if descending else ""
    placed = counts.withColumn("_bucket", F.floor(F.col(order) / width))
    totals = placed.groupBy(*key, "_bucket").agg(*(F.sum(c).alias(f"_{c}") for c in sums))
    before = totals.select(*key, "_bucket", *(F.expr(f"sum(_{c}) over (partition by {k} order by _bucket {way}) - _{c}").alias(f"_{c}") for c in sums))
    own = placed.select("*", *(F.expr(f"sum({c}) over (partition by {k}, _bucket order by {order} {way})").alias(f"run_{c}") for c in sums))
    met = own.join(before, [*key, "_bucket"])
    return met.withColumns({f"run_{c}": F.col(f"run_{c}") + F.col(f"_{c}") for c in sums}).drop("_bucket", *(f"_{c}" for c in sums))


def ranking_metrics(scores: DataFrame, key: list[str]) -> DataFrame:
    """Brier score, ROC-AUC and average precision per key, ties of a score taken together.

    Counts per distinct score come first, and running sums go by buckets of scores (``running``).
    """
    by_score = scores.groupBy(*key, "p").agg(F.sum("y").alias("pos"), F.count("*").alias("n"), F.sum(F.pow(F.col("y") - F.col("p"), F.lit(2))).alias("sq"))
    whole = by_score.groupBy(*key).agg(F.sum("pos").alias("all_pos"), F.sum("n").alias("all_n"))
    run = running(by_score, key, "p", ["pos", "n"], 1 / 1024, descending=True).withColumnsRenamed({"run_pos": "tp", "run_n": "seen"}).join(whole, key)
    below = (F.col("all_n") - F.col("all_pos")) - (F.col("seen") - F.col("tp"))
    auc = F.sum(F.col("pos") * (below + 0.5 * (F.col("n") - F.col("pos")))) / F.max(F.col("all_pos") * (F.col("all_n") - F.col("all_pos")))
    return run.groupBy(*key).agg(
        (F.sum("sq") / F.sum("n")).alias("brier"), auc.alias("roc_auc"), (F.sum(F.col("pos") / F.col("all_pos") * F.col("tp") / F.col("seen"))).alias("average_precision"), F.sum("n").alias("n")
    )


def confusion(scores: DataFrame, key: list[str], threshold: float = 0.5) -> DataFrame:
    """Counts, precision, recall and F1 per key; 0 where a ratio is undefined."""
    hit = F.col("p") >= threshold
    c = scores.groupBy(*key).agg(
        F.count_if(hit & (F.col("y") == 1)).alias("tp"), F.count_if(hit & (F.col("y") == 0)).alias("fp"), F.count_if(~hit & (F.col("y") == 1)).alias("fn"), F.count_if(~hit & (F.col("y") == 0)).alias("tn")
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    c = c.withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    return c.withColumn("f1", ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")))


def quantiles(df: DataFrame, key: list[str], column: str, shares: tuple[float, ...] = (0.25, 0.5, 0.75), buckets: int = 1024) -> DataFrame:
    """Exact quantiles with linear interpolation, as ``q25, q50, ..``: counts of distinct values, then ranks by ``running``."""
    values = df.where(F.col(column).isNotNull()).groupBy(*key, F.col(column).alias("v")).agg(F.count("*").alias("n"))
    ends = values.groupBy(*key).agg(F.min("v").alias("a"), F.max("v").alias("b"), F.sum("n").alias("all"))
    placed = values.join(ends, key).withColumn("u", F.coalesce(F.expr("try_divide(v - a, b - a)"), F.lit(0.0)))
    ranks = running(placed, key, "u", ["n"], 1 / buckets)  # rows up to and with this value
    out = []
    for q in shares:
        # The ranks (from 0) on both sides of the place q * (all - 1), and the values that hold them.
        low = F.floor(q * (F.col("all") - 1))
        for name, rank in (("lo", low), ("hi", F.least(low + 1, F.col("all") - 1))):
            out.append(F.max(F.when((rank < F.col("run_n")) & (rank >= F.col("run_n") - F.col("n")), F.col("v"))).alias(f"{name}{int(q * 100)}"))
    found = ranks.groupBy(*key).agg(F.max("all").alias("all"), *out)
    blend = [F.expr(f"lo{i} + (hi{i} - lo{i}) * ({q!r}D * (all - 1) - floor({q!r}D * (all - 1)))").alias(f"q{i}") for q, i in ((q, int(q * 100)) for q in shares)]
    return found.select(*key, *blend)


def feature_summary(df: DataFrame, key: list[str], column: str) -> DataFrame:
    """Count, missing, extremes, mean, population deviation and exact quartiles of a feature."""
    c = F.col(column)
    plain = df.groupBy(*key).agg(F.count("*").alias("n"), F.count_if(c.isNull()).alias("missing"), F.min(c).alias("least"), F.avg(c).alias("mean"), F.max(c).alias("most"), F.stddev_pop(c).alias("deviation"))
    return plain.join(quantiles(df, key, column), key, "left")


def drift_screen(reference: DataFrame, other: DataFrame, key: list[str], most_missing: float = 0.1, most_shift: float = 0.5) -> DataFrame:
    """Whether each key's summary in ``other`` stays near that in ``reference`` (both from ``feature_summary``)."""
    joined = reference.alias("a").join(other.alias("b"), key)
    sigma = F.greatest(F.col("a.deviation"), F.lit(1e-12))
    shift = F.greatest(F.abs(F.col("a.mean") - F.col("b.mean")), *(F.abs(F.col(f"a.q{q}") - F.col(f"b.q{q}")) for q in (25, 50, 75))) / sigma
    gap = F.abs(F.col("a.missing") / F.col("a.n") - F.col("b.missing") / F.col("b.n"))
    both_empty = (F.col("a.missing") == F.col("a.n")) & (F.col("b.missing") == F.col("b.n"))
    return joined.select(*key, gap.alias("missing_gap"), shift.alias("shift"), (both_empty | ((gap <= most_missing) & (F.coalesce(shift, F.lit(1e9)) <= most_shift))).alias("passes"))


def slope(raster: DataFrame, metres: float = 30.0) -> DataFrame:
    """Slope in degrees by central differences, one-sided at edges; ``r, c, elevation_m`` in."""
    along = "over (partition by r order by c)"
    down = "over (partition by c order by r)"
    d = raster.select(
        "*",
        *(F.expr(f"{fn}(elevation_m) {over}").alias(name) for fn, over, name in (("lag", along, "w"), ("lead", along, "e"), ("lag", down, "n"), ("lead", down, "s"))),
    )
    grad = lambda a, b: (F.coalesce(F.col(b), F.col("elevation_m")) - F.coalesce(F.col(a), F.col("elevation_m"))) / (
        metres * F.greatest(F.lit(1), F.col(a).isNotNull().cast("int") + F.col(b).isNotNull().cast("int"))
    )
    d = d.withColumn("gx", grad("w", "e")).withColumn("gy", grad("n", "s"))
    return d.select("r", "c", "elevation_m", F.degrees(F.atan(F.sqrt(F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy")))).alias("slope_deg"))


def content_digest(df: DataFrame) -> DataFrame:
    """Order-free digest of a table: row count, and sum of the first 15 hex digits of each row's hash."""
    row = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    return df.agg(F.count("*").alias("n"), F.sum(F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(38,0)")).alias("digest"))


def holdout_masks(df: DataFrame, time: str, share: float, target: str = "y") -> DataFrame:
    """``df`` with ``part`` by its distinct times: the first share trains, the rest evaluates.

    Times are few and numbered in one small sort. A side without rows, or with one class only, stops the job.
    """
    times = df.groupBy(time).agg(F.count_if(F.col(target) == 1).alias("pos"), F.count_if(F.col(target) != 1).alias("neg"))
    numbered = times.select("*", F.expr(f"row_number() over (order by {time})").alias("k"), F.expr("count(*) over ()").alias("n"))
    part = numbered.withColumn("part", F.when(F.col("k") <= F.floor(F.col("n") * share), "train").otherwise("evaluation"))
    sides = part.groupBy("part").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    good = sides.agg((F.count_if((F.col("pos") > 0) & (F.col("neg") > 0)) == 2).alias("_good"))
    told = refuse(part.crossJoin(F.broadcast(good)), ~F.col("_good"), F.lit("a side is empty or of one class"))
    return df.join(told.select(time, "part"), time)


def pooled_summary(reports: DataFrame, key: list[str]) -> DataFrame:
    """Reports of sequences pooled per key: summed counts and their ratios, row-weighted Brier score, mean errors.

    A distance that is undefined counts as such and not as zero.
    """
    counts = ["tp", "fp", "fn", "tn", "covered"]
    size = F.sum(F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))
    own = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    out = reports.groupBy(*key).agg(
        F.count("*").alias("sequence_count"), *(F.sum(c).alias(c) for c in counts), size.alias("row_count"),
        (F.sum(F.when(F.col("brier").isNotNull(), F.col("brier") * own)) / size).alias("brier"), F.avg(F.abs(F.col("fp") - F.col("fn"))).alias("area_mae"),
        F.avg("distance").alias("mean_distance"), F.count("distance").alias("defined_distances"), F.count_if(F.col("distance").isNull()).alias("undefined_distances"),
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return out.withColumns({"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "accuracy": F.try_divide(tp + F.col("tn"), F.col("row_count")), "coverage": F.try_divide(F.col("covered"), F.col("row_count"))})


def intensity(brightness: str) -> Column:
    """Brightness as a share of 305 to 367 K, clipped."""
    return F.expr(f"least(1D, greatest(0D, ({brightness} - 305D) / 62D))")


def intensity_calibration(observed: DataFrame, brightness: str, columns: list[str], bins: int = 5) -> DataFrame:
    """Mean of each column per intensity bin; a bin without rows has the mean of all."""
    binned = observed.select(F.least(F.floor(intensity(brightness) * bins), F.lit(bins - 1)).cast("int").alias("bin"), *columns)
    sums = binned.groupBy("bin").agg(F.count("*").alias("n"), *(F.sum(F.col(c).cast("double")).alias(c) for c in columns))
    whole = sums.agg(F.sum("n").alias("_n"), *(F.sum(c).alias(f"_{c}") for c in columns))
    frame = observed.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    met = frame.join(sums, "bin", "left").crossJoin(F.broadcast(whole))  # one row
    return met.select("bin", F.coalesce("n", F.lit(0)).alias("n"), *(F.coalesce(F.col(c) / F.col("n"), F.col(f"_{c}") / F.col("_n")).alias(c) for c in columns))


def rendered_counts(cells: DataFrame, calibration: DataFrame) -> DataFrame:
    """Synthetic detections and platforms of cells with ``intensity``: bin means rounded half-up, at least one, platforms within detections."""
    binned = cells.withColumn("bin", F.least(F.floor(F.col("intensity") * 5), F.lit(4)).cast("int"))
    met = binned.join(F.broadcast(calibration.select("bin", "detections", "platforms")), "bin")  # five rows
    n = F.greatest(F.lit(1), F.floor(F.col("detections") + 0.5).cast("int"))
    return met.withColumns({"detections": n, "platforms": F.least(n, F.greatest(F.lit(1), F.floor(F.col("platforms") + 0.5).cast("int")))}).drop("bin")


def feature_contract(df: DataFrame, part: str, time: str, target: str, features: list[str]) -> DataFrame:
    """Per part: rows, positives, first and last time, and the missing values of every feature."""
    return df.groupBy(part).agg(F.count("*").alias("n_rows"), F.sum(target).alias("n_positive"), F.min(time).alias("first_at"), F.max(time).alias("last_at"), *(F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in features))
