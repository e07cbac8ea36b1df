"""Hourly weather payloads, measurement ids, issued forecasts, backfill reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderspan.functions import grid


def explode_hourly(payloads: DataFrame, key: list[str], time: str, variables: list[str], day: str | None = None) -> DataFrame:
    """Parallel arrays as long rows ``key, observed_at, variable, value``: one row for each finite value (of ``day``).

    ``time`` holds texts without a zone, in UTC.
    """
    hours = payloads.select(*key, *([day] if day else []), F.explode(F.arrays_zip(F.col(time).alias("t"), *(F.col(v).alias(v) for v in variables))).alias("h"))
    wide = hours.select(*key, *([day] if day else []), F.to_timestamp("h.t").alias("observed_at"), *(F.col(f"h.{v}").cast("double").alias(v) for v in variables))
    wide = wide.where(F.to_date("observed_at") == F.col(day)) if day else wide
    long = wide.unpivot([*key, "observed_at"], variables, "variable", "value")
    return long.where("value is not null and not isnan(value) and abs(value) <> double('infinity')")


def with_wind(measurements: DataFrame, on: list[str], speed: str, direction: str) -> DataFrame:
    """The measurements and, where speed and direction are both there, the wind's components as two more."""
    wide = measurements.where(F.col("variable").isin(speed, direction)).groupBy(*on).agg(F.max(F.when(F.col("variable") == speed, F.col("value"))).alias("_s"), F.max(F.when(F.col("variable") == direction, F.col("value"))).alias("_d"))
    u, v = grid.wind_uv("_s", "_d")
    parts = wide.where("_s is not null and _d is not null").selectExpr(*on, f"{u} as wind_u", f"{v} as wind_v").unpivot(on, ["wind_u", "wind_v"], "variable", "value")
    return measurements.select(*on, "variable", "value").unionByName(parts)


def grid_id(model: str, latitude: str, longitude: str):
    return F.expr(f"concat({model}, ':', format_string('%.5f', {latitude}), ':', format_string('%.5f', {longitude}))")


def measurement_id(*parts: str):
    return F.concat(F.lit("weather:"), F.sha2(F.concat_ws("|", *parts), 256))


def normalize_forecasts(raw: DataFrame, key: list[str]) -> DataFrame:
    """Issued forecasts with availability (told, else publication) and its basis, lead hours and a stable id.

    What was available before its run, or has one coordinate without the other, has a ``fault``.
    """
    known = F.coalesce("availability_at", "published_at")
    basis = F.when(F.col("availability_at").isNotNull(), "explicit").when(F.col("published_at").isNotNull(), "published")
    out = raw.withColumns({"known_at": known, "availability_basis": basis, "lead_hours": (F.unix_micros("valid_at") - F.unix_micros("run_at")) / 3.6e9})
    fault = (
        F.when(F.col("known_at").isNull(), "no-availability")
        .when(F.col("known_at") < F.col("run_at"), "available-before-run")
        .when(F.col("latitude").isNull() != F.col("longitude").isNull(), "half-a-coordinate")
    )
    return out.withColumns({"fault": fault, "forecast_id": F.sha2(F.concat_ws("|", *key, F.unix_seconds("run_at").cast("string"), F.unix_seconds("valid_at").cast("string")), 256)})


def backfill_report(wanted: DataFrame, measured: DataFrame, date: str, on: list[str]) -> DataFrame:
    """Per date: required values, those that are there, tiles that lack one, and whether the date is complete."""
    have = measured.select(date, *on).distinct().withColumn("_have", F.lit(1))
    met = wanted.select(date, *on).distinct().join(have, [date, *on], "left")
    tile = met.groupBy(date, on[0]).agg(F.count("*").alias("w"), F.count("_have").alias("h"))
    return tile.groupBy(date).agg(F.sum("w").alias("n_required"), F.sum("h").alias("n_present"), F.count_if(F.col("h") < F.col("w")).alias("n_partial_tiles"), F.bool_and(F.col("h") == F.col("w")).alias("complete"))
