"""Domain tables derived from the test tables: detections, ledger, forecasts, rasters, scores.

The SQL reads the registered views of either engine; ``{S}`` is its string type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cinderspan.functions import grid
from cinderspan.session import table

SOLAR = grid.solar_offset_us

SQL = {
    "detections": """select concat('d', cast(event_id as {S})) as detection_id, cast(ts as timestamp) as acquired_at,
        35 + (user_id*17 % 250)/1e1 + ((event_id*31) % 21 - 10)*4e-3 as latitude,
        -120 + (user_id*29 % 500)/1e1 + ((event_id*47) % 21 - 10)*6e-3 as longitude,
        300 + least(value, 1e2)*67e-2 as bright_ti4,
        case event_type when 'view' then 'VIIRS_NOAA20_NRT' when 'purchase' then 'VIIRS_NOAA21_NRT' else 'VIIRS_SNPP_NRT' end as product,
        concat('raw-', cast(cast(ts as date) as {S})) as raw_artifact_id, user_id as fire_id,
        case when user_id % 3 = 0 then 'Canada' else 'CONUS' end as region, event_type from events""",
    "ledger": """select concat('firms:P', cast(o_custkey % 3 as {S}), ':', cast(cast(o_orderdate as date) as {S})) as expected_coverage_id,
        case when o_orderkey % 10 < 6 then 'complete' when o_orderkey % 10 < 8 then 'empty-confirmed'
             when o_orderkey % 10 < 9 then 'partial' else 'failed' end as status,
        cast(o_orderdate as timestamp) as recorded_at, o_orderkey as append_order from orders""",
    "forecasts": """select concat('g', cast(l_partkey % 50 as {S})) as source_grid_id, concat('v', cast(l_suppkey % 5 as {S})) as variable,
        cast(l_shipdate as timestamp) as run_day, cast((l_linenumber % 4)*6 as int) as run_hour,
        cast((l_linenumber % 4)*6*60 + floor(l_quantity)*6 as int) as avail_minute,
        cast((l_linenumber % 4)*6 + l_orderkey % 48 as int) as valid_hour, l_extendedprice as value, l_orderkey*10 + l_linenumber as seq
        from lineitem""",
    "raster": "select cast(floor(p_partkey/2e1) as int) as r, cast(p_partkey % 20 as int) as c, cast(floor(p_retailprice) as int) as elevation_m from part",
    "scores": """select event_id, case when event_type='purchase' then 1 else 0 end as y, (event_id*7919 % 997)/997e0 as p,
        cast(user_id % 4 as int) as split_no, cast(event_id % 8 + 1 as int) as step from events""",
}
TABLES = {"detections": "events", "ledger": "orders", "forecasts": "lineitem", "raster": "part", "scores": "events"}


def oracle(name: str) -> str:
    """A derived table as a DuckDB subquery."""
    return "(" + SQL[name].replace("{S}", "varchar") + ")"


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table as a DataFrame."""
    return spark.sql(SQL[name].replace("{S}", "string").replace(f"from {TABLES[name]}", "from {source}"), source=table(spark, sf_dir, TABLES[name]))


def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections with their grid cell ``x, y``."""
    x, y = grid.cell_xy("latitude", "longitude")
    return derived(spark, sf_dir, "detections").selectExpr("*", f"{x} as x", f"{y} as y")


def located_oracle() -> str:
    x, y = grid.cell_xy("latitude", "longitude")
    return f"(select *, {x} as x, {y} as y from {oracle('detections')} d0)"
