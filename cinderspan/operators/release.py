"""Canonical release lines, storage accounting and run comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _field(name: str, kind: T.DataType) -> Column:
    value = F.col(f"`{name}`")
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        value = F.to_json(value)
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.when(text.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def canonical_csv(df: DataFrame) -> DataFrame:
    """Rows as CSV lines: columns in name order, null as empty, nested values as JSON, quotes only where needed."""
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    return df.select(F.concat_ws(",", *(_field(f.name, f.dataType) for f in fields)).alias("line"))


def storage_usage(files: DataFrame, caps: DataFrame, total_cap: int) -> DataFrame:
    """Bytes, cap and rest per category (``category, bytes``), and of all as ``whole-data``."""
    used = files.rollup("category").agg(F.sum("bytes").alias("used"), F.count("*").alias("n_files"), F.grouping("category").alias("_all"))
    named = used.withColumn("category", F.when(F.col("_all") == 1, "whole-data").otherwise(F.coalesce("category", F.lit("other"))))
    limits = caps.unionByName(caps.sparkSession.createDataFrame([("whole-data", total_cap)], caps.schema))
    joined = named.join(limits, "category", "left")
    return joined.select("category", "used", "n_files", "cap", (F.col("cap") - F.col("used")).alias("remaining"))


def score_domain(domain: DataFrame, predictions: DataFrame, on: list[str], key: list[str]) -> DataFrame:
    """Counts, Brier score, coverage and area error per key; a row without a prediction counts as 0 and false."""
    met = domain.join(predictions, on, "left")
    p, will, y = F.coalesce("probability", F.lit(0.0)), F.coalesce("will_ignite", F.lit(False)), F.col("y") == 1
    out = met.groupBy(*key).agg(
        F.count_if(y & will).alias("tp"), F.count_if(~y & will).alias("fp"), F.count_if(y & ~will).alias("fn"), F.count_if(~y & ~will).alias("tn"),
        F.avg((F.col("y") - p) * (F.col("y") - p)).alias("brier"), F.avg(F.when(F.col("probability").isNotNull(), 1.0).otherwise(0.0)).alias("coverage"),
    )
    return out.withColumn("area_error", F.abs(F.col("fp") - F.col("fn")))


def compare_runs(first: DataFrame, second: DataFrame, key: list[str], metrics: dict[str, bool]) -> DataFrame:
    """Metrics of two runs side by side, one row each; ``metrics`` maps a name to whether more is better.

    Cases must be the same in both: one that a run lacks has nulls.
    """
    long = lambda df, name: df.select(*key, *(F.col(m).cast("double").alias(m) for m in metrics)).unpivot(key, list(metrics), "metric", name)
    met = long(first, "before").join(long(second, "after"), [*key, "metric"], "full_outer")
    better = F.col("metric").isin([m for m, more in metrics.items() if more])
    return met.withColumn("change", F.col("after") - F.col("before")).withColumn("regressed", F.when(better, F.col("change") < 0).otherwise(F.col("change") > 0))
