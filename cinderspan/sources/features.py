"""Readers of captured pages: polygon features, GeoJSON collections and granule inventories.

A file holds one page a line, or, with ``lines=False``, one page in all. Schemas are given, so nothing is read
twice. A page or feature that breaks the format stops the job with its file's name; none is skipped. A
page without features is a valid empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspan.operators.records import refuse

ATTRIBUTES = "primarykey string, region string, fireid long, t long, n_newpixels int"
# Bytes of the decimal size units.
UNITS = {"b": 1, "kb": 10**3, "mb": 10**6, "gb": 10**9}


def _pages(spark: SparkSession, path: str, schema: str, lines: bool) -> DataFrame:
    """Pages with the file they come from; a line that is no JSON object stops the job."""
    pages = spark.read.schema(schema).json(path, multiLine=not lines, mode="FAILFAST")
    return pages.select("*", F.col("_metadata.file_path").alias("raw_file"))


def _refuse(rows: DataFrame, bad: Column, what: str) -> DataFrame:
    return refuse(rows, bad, F.concat(F.lit(f"{what}: "), "raw_file"))


def _items(pages: DataFrame, items: str, bad: Column, what: str) -> DataFrame:
    """``raw_file`` and each item as ``f``; an item for which ``bad`` holds stops the job.

    The outer form keeps pages without a list in the plan until their own refusal; else the scan would pass over them. Its row for
    an empty page goes after the items are judged, as Spark may test for nulls last.
    """
    held = pages.select("raw_file", F.posexplode_outer(items).alias("_at", "f"))
    return _refuse(held, F.col("_at").isNotNull() & bad, what).where("_at is not null").drop("_at")


def read_perimeter_pages(spark: SparkSession, path: str, attributes: str = ATTRIBUTES, lines: bool = True) -> DataFrame:
    """One row per polygon feature: its attributes, ``rings`` and ``raw_file``.

    A page with an error or without a list of features is refused, and so is a feature without rings.
    """
    schema = f"error struct<code: int, message: string>, features array<struct<attributes: struct<{_typed(attributes)}>, geometry: struct<rings: array<array<array<double>>>>>>"
    pages = _refuse(_pages(spark, path, schema, lines), F.col("error").isNotNull() | F.col("features").isNull(), "no feature page")
    held = _items(pages, "features", F.col("f.attributes").isNull() | F.coalesce(F.size("f.geometry.rings") < 1, F.lit(True)), "no polygon")
    return held.select("f.attributes.*", F.col("f.geometry.rings").alias("rings"), "raw_file")


def _typed(columns: str) -> str:
    return ", ".join(": ".join(c.split()) for c in columns.split(","))


def read_geojson(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """One row per feature: ``properties`` as text by name, ``geometry`` (type, and coordinates as JSON text), ``raw_file``."""
    pages = _pages(spark, path, "type string, features array<struct<properties: map<string, string>, geometry: struct<type: string, coordinates: string>>>", lines)
    bad = (F.col("type") != "FeatureCollection") | F.col("features").isNull()
    held = _items(_refuse(pages, bad, "no feature collection"), "features", F.col("f.properties").isNull() | F.col("f.geometry").isNull(), "no properties or geometry")
    return held.select("f.properties", "f.geometry", "raw_file")


def reference_perimeters(features: DataFrame) -> DataFrame:
    """Final reference perimeters of GeoJSON features: tier and quality are set, properties stay as source fields."""
    return features.select(
        F.lit("final_reference").alias("label_tier"), F.lit(0.55).alias("label_quality_score"), F.lit(False).alias("historical_snapshot_recreated"), "geometry", F.col("properties").alias("source_fields"), "raw_file"
    )


def incident_history(features: DataFrame) -> DataFrame:
    """Incident intervals of GeoJSON features: the national id, else the record's own; a feature with neither is refused."""
    own = F.nullif(F.col("properties.id"), F.lit(""))
    known = F.coalesce(F.nullif(F.col("properties.national_fire_id"), F.lit("")), own)
    return _refuse(features, known.isNull(), "no incident id").select(
        known.alias("incident_id"),
        own.alias("source_record_id"),
        *(F.expr(f"try_to_timestamp(properties.{c})").alias(c) for c in ("record_start", "record_end")),
        "geometry",
        F.col("properties").alias("source_fields"),
        "raw_file",
    )


def intersects_dates(start: str, end: str, first: str | None, last: str | None) -> Column:
    """Whether a half-open interval meets dates, both included; an open side takes all."""
    test = F.lit(True)
    if first:
        test &= F.col(end) > F.lit(first).cast("timestamp")
    if last:
        test &= F.col(start) < F.lit(last).cast("timestamp") + F.expr("interval 1 day")
    return test


def intersects_extent(start: str, end: str, first: str, last: str) -> Column:
    """Whether a window meets an extent whose end is an instant that was seen, so it belongs to it."""
    return (F.col(end) > F.col(first)) & (F.col(start) <= F.col(last))


def read_granules(spark: SparkSession, path: str, product: str, version: str, lines: bool = True) -> DataFrame:
    """One row per inventory item: name, interval, the first download address, size in bytes, checksum.

    Refused: another product or version, an interval that doesn't end after it begins, no https address of
    an ``.nc`` file, a size of unknown unit, a checksum without its algorithm or the other way round.
    """
    info = "array<struct<Size: double, SizeUnit: string, Checksum: struct<Value: string, Algorithm: string>>>"
    umm = (
        "struct<GranuleUR: string, CollectionReference: struct<ShortName: string, Version: string>, TemporalExtent: struct<RangeDateTime: struct<BeginningDateTime: timestamp, EndingDateTime: timestamp>>,"
        f" RelatedUrls: array<struct<URL: string, Type: string>>, DataGranule: struct<ArchiveAndDistributionInformation: {info}>>"
    )
    pages = _pages(spark, path, f"items array<struct<umm: {umm}>>", lines)
    item = _items(_refuse(pages, F.col("items").isNull(), "no inventory"), "items", F.col("f.umm.GranuleUR").isNull(), "other product").select("raw_file", "f.umm.*")
    span, file = F.col("TemporalExtent.RangeDateTime"), F.get(F.col("DataGranule.ArchiveAndDistributionInformation"), F.lit(0))
    factor = F.create_map(*(F.lit(x) for kv in UNITS.items() for x in kv))[F.lower(file["SizeUnit"])]
    address = F.get(F.filter("RelatedUrls", lambda u: (u["Type"] == "GET DATA") & u["URL"].rlike(r"^https://.*\.nc$")), F.lit(0))["URL"]
    value, algorithm = file["Checksum"]["Value"], file["Checksum"]["Algorithm"]
    of_product = (F.col("CollectionReference.ShortName") == product) & (F.col("CollectionReference.Version") == version)
    faults = {
        "other product": ~of_product,
        "empty interval": span["EndingDateTime"] <= span["BeginningDateTime"],
        "no download address": address.isNull(),
        "unknown size unit": file["Size"].isNotNull() & factor.isNull(),
        "half a checksum": value.isNull() != algorithm.isNull(),
    }
    for what, bad in faults.items():
        item = _refuse(item, bad, what)
    return item.select(
        F.col("GranuleUR").alias("granule_id"),
        span["BeginningDateTime"].alias("begins_at"),
        span["EndingDateTime"].alias("ends_at"),
        address.alias("download_url"),
        F.round(file["Size"] * factor).cast("bigint").alias("bytes"),
        value.alias("checksum"),
        algorithm.alias("checksum_algorithm"),
        "raw_file",
    )


def granule_days(days: DataFrame, granules: DataFrame, now: Column, lag_h: int = 24) -> DataFrame:
    """Status of each row of ``days`` (``product, day``): complete when all listed granules are; without any, empty once the lag has passed."""
    listed = granules.groupBy("product", "day").agg(F.count("*").alias("n_granules"), F.count_if(F.col("status") == "complete").alias("n_complete"))
    met = days.join(listed, ["product", "day"], "left").fillna(0, ["n_granules", "n_complete"])
    over = now >= F.col("day").cast("timestamp") + F.expr(f"interval {24 + lag_h} hours")
    none = F.when(over, "empty").otherwise("pending")
    return met.withColumn("status", F.when(F.col("n_granules") == 0, none).when(F.col("n_complete") == F.col("n_granules"), "complete").otherwise("partial"))


# Storage categories by the start of a path; the first that fits counts.
CATEGORIES = {
    "firms_and_detection_evidence": ["raw/nasa-firms/", "normalized/fire-detections/"],
    "viirs_l2_paired_cutouts": [
        "raw/nasa-cmr-viirs-l2-observability/", "raw/nasa-lp-daac-viirs-l2-observability/", "raw/nasa-laads-viirs-geolocation/", "normalized/satellite-observation-coverage/", "l2/",
    ],
    "operational_labels_and_progression": [
        "raw/nifc-wfigs/", "raw/nifc-irwin/", "raw/nasa-feds", "raw/cwfis", "normalized/operational-perimeters/", "normalized/incident-snapshots/", "normalized/fire-progression/",
    ],
    "issued_weather_tiles": [
        "raw/noaa-hrrr/", "raw/eccc-hrdps/", "raw/open-meteo-single-runs/", "raw/open-meteo-historical-weather/", "normalized/forecast-weather/", "normalized/open-meteo-forecast-tile-assignments/",
        "normalized/historical-weather/", "normalized/open-meteo-historical-weather-tile-assignments/", "weather/",
    ],
    "static_cell_features": ["raw/noaa-ncei-etopo-terrain/", "raw/cec-nalcms-land-cover/", "static/", "normalized/static-cell-features/"],
    "manifests_staging_and_headroom": ["manifests/", "state/", "retention/", "staging/"],
    "derived_training_views": ["exports/", "derived/", "normalized/"],
}


def storage_category(path: str) -> Column:
    """The category of a path below the data root, slashes at its ends aside."""
    own = F.expr(f"trim(both '/' from {path})")
    found = F.when(F.lit(False), "")
    for name, starts in CATEGORIES.items():
        test = F.lit(False)
        for start in starts:
            test |= own.startswith(start)
        found = found.when(test, name)
    return found.otherwise("unallocated")
