"""Captured pages that break their format are refused; empty ones are valid."""

import json

import pytest
from pyspark.sql import functions as F

from cinderspan.operators import frontier, ledger
from cinderspan.sources import features

RING = [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0]]]
UMM = {
    "GranuleUR": "G", "CollectionReference": {"ShortName": "P", "Version": "2"}, "RelatedUrls": [{"URL": "https://a/x.nc", "Type": "GET DATA"}],
    "TemporalExtent": {"RangeDateTime": {"BeginningDateTime": "2024-01-01T00:00:00Z", "EndingDateTime": "2024-01-01T00:06:00Z"}},
    "DataGranule": {"ArchiveAndDistributionInformation": [{"Size": 1.5, "SizeUnit": "MB", "Checksum": {"Value": "ab", "Algorithm": "MD5"}}]},
}
GEO = {"properties": {"id": 7, "national_fire_id": ""}, "geometry": {"type": "Point", "coordinates": [1, 2]}}


def page(tmp_path, *pages):
    path = tmp_path / "pages.json"
    path.write_text("\n".join(json.dumps(p) for p in pages))
    return str(path)


def refused(df, what):
    with pytest.raises(Exception, match=what):
        df.collect()


def test_perimeter_pages(spark, tmp_path):
    good = {"features": [{"attributes": {"region": "CONUS", "fireid": 3}, "geometry": {"rings": RING}}]}
    rows = features.read_perimeter_pages(spark, page(tmp_path, good, {"features": []})).collect()
    assert [(r.fireid, r.primarykey, r.rings) for r in rows] == [(3, None, RING)]
    refused(features.read_perimeter_pages(spark, page(tmp_path, {"error": {"code": 400}})), "no feature page")
    refused(features.read_perimeter_pages(spark, page(tmp_path, {"features": [{"attributes": {"fireid": 3}, "geometry": {"rings": []}}]})), "no polygon")


def test_geojson(spark, tmp_path):
    found = features.read_geojson(spark, page(tmp_path, {"type": "FeatureCollection", "features": [GEO]}))
    assert features.incident_history(found).first().incident_id == "7"
    assert json.loads(features.reference_perimeters(found).first().geometry.coordinates) == [1, 2]
    nameless = features.read_geojson(spark, page(tmp_path, {"type": "FeatureCollection", "features": [GEO | {"properties": {"x": "1"}}]}))
    refused(features.incident_history(nameless), "no incident id")
    refused(features.read_geojson(spark, page(tmp_path, {"type": "Feature", "features": []})), "no feature collection")


def test_granules(spark, tmp_path):
    row = features.read_granules(spark, page(tmp_path, {"items": [{"umm": UMM}]}), "P", "2").first()
    assert (row.granule_id, row.bytes, row.download_url, row.checksum) == ("G", 1_500_000, "https://a/x.nc", "ab")
    span = {"RangeDateTime": {"BeginningDateTime": "2024-01-01T00:00:00Z", "EndingDateTime": "2024-01-01T00:00:00Z"}}
    for change, what in (({"RelatedUrls": [{"URL": "http://a/x.nc", "Type": "GET DATA"}]}, "no download address"), ({"TemporalExtent": span}, "empty interval"), ({"CollectionReference": {"ShortName": "Q", "Version": "2"}}, "other product")):
        refused(features.read_granules(spark, page(tmp_path, {"items": [{"umm": UMM | change}]}), "P", "2"), what)


def test_refused_rows(spark):
    refused(frontier.frontier_rows(spark.range(3).select(F.col("id").alias("firms_center_has_detection"))), "must be 0 or 1")
    times = spark.sql("select 1 as k, timestamp '2024-01-01 03:00:00' as t")
    refused(ledger.regular_sequences(times, ["k"], "t"), "irregular time")
    assert ledger.regular_sequences(times, ["k"], "t", until="2024-01-01").count() == 0
