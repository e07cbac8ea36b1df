"""Raster blocks as pixel tables: slope and aspect, the pixel of a point, decoded features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks of missing data, mean Earth radius in metres, the slope below which ground is flat.
NO_ELEVATION, NO_ASPECT, RADIUS, FLAT = -32768, 255, 6_371_008.8, 0.05


def slope_aspect(pixels: DataFrame, block: list[str], north: float, width: float, height: float) -> DataFrame:
    """Quantized slope (half degrees) and downhill aspect (two degrees) of ``block, r, c, elevation_m``.

    Central differences, one-sided at edges, over metres at the row's latitude. A pixel or a
    neighbour without data has no slope; flat ground has no aspect.
    """
    by = lambda first, then: f"over (partition by {', '.join([*block, first])} order by {then})"
    value = f"nullif(elevation_m, {NO_ELEVATION})"
    out = pixels.select("*", F.expr(f"cast({value} as double)").alias("_v"), *(F.expr(f"row_number() {by(a, b)}").alias(n) for n, a, b in (("_i", "r", "c"), ("_j", "c", "r"))))
    near = {"w": ("lag", "r", "c"), "e": ("lead", "r", "c"), "n": ("lag", "c", "r"), "s": ("lead", "c", "r")}
    out = out.select("*", *(F.expr(f"{f}(_v) {by(a, b)}").alias(f"_{n}") for n, (f, a, b) in near.items()), *(F.expr(f"{f}(1) {by(a, b)}").alias(f"_has_{n}") for n, (f, a, b) in near.items()))
    # The missing neighbour of an edge is the pixel itself, over one step; a neighbour without data leaves null.
    diff = lambda a, b: f"(if(_has_{b} is null, _v, _{b}) - if(_has_{a} is null, _v, _{a})) / nullif(coalesce(_has_{a}, 0) + coalesce(_has_{b}, 0), 0)"
    latitude = f"({north!r}D - (r + 0.5D) * {height!r}D)"
    out = out.withColumns(
        {
            "_east": F.expr(f"({diff('w', 'e')}) / ({RADIUS!r}D * cos(radians({latitude})) * radians({width!r}D))"),
            "_north": F.expr(f"-({diff('n', 's')}) / ({RADIUS!r}D * radians({height!r}D))"),
        }
    )
    slope = F.degrees(F.atan(F.hypot("_east", "_north")))
    known = F.col("_v").isNotNull() & slope.isNotNull()
    return out.select(
        *block, "r", "c", "elevation_m",
        F.when(known, F.least(F.greatest(F.rint(slope * 2), F.lit(0.0)), F.lit(180.0)).cast("int")).otherwise(0).alias("slope_x2"),
        F.when(known & (slope >= FLAT), F.expr("pmod(rint(pmod(degrees(atan2(-_east, -_north)), 360D) / 2), 180D)").cast("int")).otherwise(NO_ASPECT).alias("aspect_x2"),
    )


def pixel_index(ratio: Column) -> Column:
    """The pixel of a position in pixels; one within 1e-9 of a border is on it."""
    return F.floor(F.when(F.abs(ratio - F.rint(ratio)) <= 1e-9, F.rint(ratio)).otherwise(ratio)).cast("int")


def sample(points: DataFrame, key: str, blocks: DataFrame, pixels: DataFrame, degrees: int = 1) -> DataFrame:
    """Each point (``key, latitude, longitude``) with the pixel of the best block that holds it; one without a block has its status.

    Blocks (``block_id, width, height, west, north, pixel_width, pixel_height``) and points meet on the
    whole degrees that blocks cover, an equi-join. Of overlapping blocks the one in which the pixel lies
    farthest from the edge is taken, then the finer one, then the smaller id.
    """
    span = lambda a, b: F.explode(F.sequence(F.floor(a / degrees).cast("int"), F.floor(b / degrees).cast("int")))
    east, south = F.col("west") + F.col("width") * F.col("pixel_width"), F.col("north") - F.col("height") * F.col("pixel_height")
    tiled = blocks.select("*", span(F.col("west"), east).alias("_tx")).select("*", span(south, F.col("north")).alias("_ty"))
    own = points.select("*", F.floor(F.col("longitude") / degrees).cast("int").alias("_tx"), F.floor(F.col("latitude") / degrees).cast("int").alias("_ty"))
    met = own.join(tiled, ["_tx", "_ty"]).withColumns(
        {"row": pixel_index((F.col("north") - F.col("latitude")) / F.col("pixel_height")), "col": pixel_index((F.col("longitude") - F.col("west")) / F.col("pixel_width"))}
    )
    met = met.where("row >= 0 and row < height and col >= 0 and col < width")
    edge = F.least("row", "col", F.col("height") - 1 - F.col("row"), F.col("width") - 1 - F.col("col"))
    best = met.groupBy(key).agg(F.min_by(F.struct("block_id", "row", "col"), F.struct(-edge, F.col("pixel_width") * F.col("pixel_height"), "block_id")).alias("p"))
    values = best.select(key, "p.*").join(pixels.withColumnsRenamed({"r": "row", "c": "col"}), ["block_id", "row", "col"], "left")
    return decode(points.join(values, key, "left"))


def decode(df: DataFrame) -> DataFrame:
    """Features of stored pixels: metres, degrees, the aspect as a unit vector with a flag, and why one is missing."""
    status = F.when(F.col("block_id").isNull(), "outside-retained-terrain-coverage").when(F.col("elevation_m").isNull() | (F.col("elevation_m") == NO_ELEVATION), "source-no-data").otherwise("sampled")
    valid = status == "sampled"
    defined = valid & (F.col("aspect_x2") != NO_ASPECT)
    turned = F.radians(F.col("aspect_x2") * 2.0)
    return df.withColumns(
        {
            "terrain_status": status,
            "terrain_elevation_m": F.when(valid, F.col("elevation_m").cast("double")),
            "terrain_slope": F.when(valid, F.col("slope_x2") / 2),
            "terrain_aspect_sin": F.when(defined, F.sin(turned)).when(valid, 0.0),
            "terrain_aspect_cos": F.when(defined, F.cos(turned)).when(valid, 0.0),
            "terrain_aspect_defined": defined,
        }
    ).drop("slope_x2", "aspect_x2", "elevation_m")


def source_blocks(tiles: DataFrame, degrees: float = 10.0, halo: int = 1, pixel: float = 1 / 240) -> DataFrame:
    """Blocks of a degree grid that context tiles (``tile_id, west, south, east, north``) touch, with halo, size and tiles.

    A tile touches few blocks; a block holds the tiles of its 10 degrees, so lists stay bounded.
    """
    span = lambda a, b, origin: F.explode(F.sequence(F.floor((F.col(a) - origin) / degrees).cast("int"), (F.ceil((F.col(b) - origin) / degrees) - 1).cast("int")))
    met = tiles.select("*", span("west", "east", -180).alias("bx")).select("*", span("south", "north", -90).alias("by"))
    out = met.groupBy("bx", "by").agg(F.count_distinct("tile_id").alias("n_tiles"), F.array_join(F.array_sort(F.collect_set("tile_id")), " ").alias("tile_ids"))
    out = out.withColumns(
        {
            "request_west": F.greatest(F.lit(-180.0), F.lit(-180.0) + F.col("bx") * degrees - halo * pixel), "request_east": F.least(F.lit(180.0), F.lit(-180.0) + (F.col("bx") + 1) * degrees + halo * pixel),
            "request_south": F.greatest(F.lit(-90.0), F.lit(-90.0) + F.col("by") * degrees - halo * pixel), "request_north": F.least(F.lit(90.0), F.lit(-90.0) + (F.col("by") + 1) * degrees + halo * pixel),
        }
    )
    size = lambda a, b: F.rint((F.col(b) - F.col(a)) / pixel).cast("int")
    return out.withColumns({"width": size("request_west", "request_east"), "height": size("request_south", "request_north")})
