"""Append-only coverage ledger, issued forecasts, windows and sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TERMINAL = ("complete", "empty-confirmed")


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key by ``order`` (ascending columns, last wins): one map-side combined aggregate."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return newest.select(*keys, *(F.col(f"_r.{c}").alias(c) for c in rest))


def coverage_gaps(expected: DataFrame, ledger: DataFrame) -> DataFrame:
    """Expected windows whose newest entry isn't terminal, or that have none."""
    state = latest_by(ledger, ["expected_coverage_id"], ["recorded_at", "append_order"])
    return expected.join(state.where(F.col("status").isin(*TERMINAL)), "expected_coverage_id", "left_anti")


def range_status(status: str = "status") -> Column:
    """Roll-up: failed before partial before all empty before complete."""
    return (
        F.when(F.bool_or(F.col(status) == "failed"), "failed")
        .when(F.bool_or(F.col(status) == "partial"), "partial")
        .when(F.bool_and(F.col(status) == "empty-confirmed"), "empty-confirmed")
        .otherwise("complete")
    )


def expected_windows(start: Column, end: Column, hours: int) -> Column:
    """Structs (start, end) of a cadence; the last is cut at ``end``."""
    starts = F.filter(F.sequence(start, end, F.expr(f"interval {hours} hours")), lambda t: t < end)
    return F.transform(starts, lambda t: F.struct(t.alias("start"), F.least(t + F.expr(f"interval {hours} hours"), end).alias("end")))


def forecasts_as_of(forecasts: DataFrame, anchors: DataFrame, keys: list[str]) -> DataFrame:
    """Per anchor and key the newest forecast known then and valid after: run <= availability <= anchor < valid.

    ``anchors`` has ``anchor_at`` and is a few rows per day. Each forecast explodes to the
    anchors of its own availability-to-validity span by day, so this is an equi-join.
    """
    days = F.explode(F.sequence(F.to_date("availability_at"), F.to_date("valid_at"))).alias("day")
    f = forecasts.where("run_at <= availability_at AND availability_at < valid_at").select("*", days)
    met = f.join(anchors.select("anchor_at", F.to_date("anchor_at").alias("day")), "day").where("availability_at <= anchor_at AND anchor_at < valid_at").drop("day")
    return latest_by(met, ["anchor_at", *keys], ["availability_at", "seq"])


def gap_sequences(times: DataFrame, key: list[str], time: str, hours: int = 12) -> DataFrame:
    """Distinct times with ``sequence`` and ``place``: a new sequence wherever the step isn't ``hours``."""
    own = times.select(*key, time).distinct()
    over = f"over (partition by {', '.join(key)} order by {time})"
    step = own.withColumn("_new", F.expr(f"case when {time} - lag({time}) {over} = interval {hours} hours then 0 else 1 end"))
    numbered = step.withColumn("sequence", F.expr(f"sum(_new) {over}")).drop("_new")
    return numbered.withColumn("place", F.expr(f"row_number() over (partition by {', '.join([*key, 'sequence'])} order by {time})"))


def regular_sequences(times: DataFrame, key: list[str], time: str, hours: int = 12, until: str | None = None) -> DataFrame:
    """``gap_sequences`` of the times before ``until``; a time off the grid of ``hours`` stops the job."""
    held = times.where(F.col(time) < F.lit(until).cast("timestamp")) if until else times
    on_grid = F.unix_micros(time) % (hours * 3_600_000_000) == 0
    checked = F.when(F.coalesce(on_grid, F.lit(False)), F.col(time)).otherwise(F.raise_error(F.concat(F.lit("irregular time: "), F.col(time).cast("string"))))
    return gap_sequences(held.withColumn(time, checked), key, time, hours)


def chronological_split(df: DataFrame, time: str, share: float = 0.8) -> DataFrame:
    """``df`` with ``dataset_split``: the first share of the distinct times trains, at least one.

    Distinct times are few (two a day); numbering them is one small sort.
    """
    times = df.select(time).distinct()
    numbered = times.select(time, F.expr(f"row_number() over (order by {time})").alias("_k"), F.expr("count(*) over ()").alias("_n"))
    split = numbered.select(time, F.when(F.col("_k") <= F.greatest(F.lit(1), F.floor(F.col("_n") * share)), "train").otherwise("validation").alias("dataset_split"))
    return df.join(split, time)
