"""Raster tiles as a table.

A raster is a tile table ``(rid, fk_time_id, srid, tile_col, tile_row, width,
height, ulx, uly, scale_x, scale_y, nodata, pixels array<double>)`` with
row-major pixels.  Tiles are bounded in size, so every per-tile step is a
bounded group; rasters of any size are many tiles, partitioned by time and
tile key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat.config import DEFAULT_SRID
from regiostat.session import materialize


@dataclass(frozen=True)
class Grid:
    """Georeference of a raster: pixel (col,row) centre is
    ``ulx + (col+0.5)*scale_x, uly + (row+0.5)*scale_y``."""
    width: int
    height: int
    ulx: float = 0.0
    uly: float = 0.0
    scale_x: float = 1.0
    scale_y: float = 1.0
    tile_w: int = 32
    tile_h: int = 32
    nodata: float = -9999.0
    srid: int = DEFAULT_SRID

    @property
    def tiles_x(self) -> int:
        return -(-self.width // self.tile_w)


def tiles_from_pixels(pixels: DataFrame, grid: Grid, layer: int = 0, keys: tuple[str, ...] = ()) -> DataFrame:
    """Pixel table ``(keys, fk_time_id, col, row, value)`` -> tile table;
    ``keys`` (``("dataset",)``) hold many rasters of one grid.

    One bounded group per tile (at most ``tile_w * tile_h`` entries); absent
    pixels become nodata.  Pixels must be unique per (time, col, row): two
    values on one position are an error, never a silent choice; overlapping
    layers become tiles of their own and :func:`mosaic_tiles` unites them.
    """
    tw, th = grid.tile_w, grid.tile_h
    p = pixels.select(
        *keys, "fk_time_id", "value",
        (F.col("col") / tw).cast("bigint").alias("tile_col"),
        (F.col("row") / th).cast("bigint").alias("tile_row"),
        ((F.col("row") % th) * tw + F.col("col") % tw).cast("int").alias("off"))
    # Densify without per-pixel map lookups: append one nodata filler per
    # offset, sort by (offset, source) and keep the first entry per offset.
    # Cost per tile is one sort of at most 2 * tile_w * tile_h entries.
    g = p.groupBy(*keys, "fk_time_id", "tile_row", "tile_col").agg(
        F.collect_list(F.struct("off", F.lit(0).alias("src"), "value")).alias("got"))
    filler = F.transform(F.sequence(F.lit(0), F.lit(tw * th - 1)),
                         lambda i: F.struct(i.alias("off"), F.lit(1).alias("src"),
                                            F.lit(grid.nodata).cast("double").alias("value")))
    g = g.withColumn("_all", F.array_sort(F.concat("got", filler)))
    firsts = F.filter("_all", lambda s, k: (k == 0) | (F.col("_all")[k - 1]["off"] != s["off"]))
    double = F.size(F.array_distinct(F.transform("got", lambda s: s["off"]))) < F.size("got")
    message = F.concat(F.lit("two pixels on one position in tile "), F.col("tile_col").cast("string"), F.lit(", "), F.col("tile_row").cast("string"))
    dense = F.when(double, F.raise_error(message).cast("array<double>")).otherwise(F.transform(firsts, lambda s: s["value"]))
    return g.select(
        F.struct(F.lit(layer).cast("bigint").alias("layer"), "fk_time_id", "tile_row", "tile_col").alias("rid"),
        *keys, "fk_time_id", F.lit(grid.srid).alias("srid"), "tile_col", "tile_row",
        F.lit(tw).alias("width"), F.lit(th).alias("height"),
        (F.lit(grid.ulx) + F.col("tile_col") * F.lit(tw * grid.scale_x)).alias("ulx"),
        (F.lit(grid.uly) + F.col("tile_row") * F.lit(th * grid.scale_y)).alias("uly"),
        F.lit(grid.scale_x).alias("scale_x"), F.lit(grid.scale_y).alias("scale_y"),
        F.lit(grid.nodata).alias("nodata"), dense.alias("pixels"))


def tile_pixels(tiles: DataFrame, keep_nodata: bool = False) -> DataFrame:
    """Tiles back to ``(fk_time_id, col, row, value)``."""
    t = tiles.select("fk_time_id", "tile_col", "tile_row", "width", "height", "nodata",
                     F.posexplode("pixels").alias("off", "value"))
    out = t.select("fk_time_id",
                   (F.col("tile_col") * F.col("width") + F.col("off") % F.col("width")).alias("col"),
                   (F.col("tile_row") * F.col("height") + (F.col("off") / F.col("width")).cast("bigint")).alias("row"),
                   "value", "nodata")
    if not keep_nodata:
        out = nodata_mask(out)
    return out.drop("nodata")


def nodata_mask(values: DataFrame, value: str = "value", nodata: str = "nodata") -> DataFrame:
    """Drop nodata (``exclude_nodata_value = true``); NaN counts as nodata."""
    v = F.col(value)
    return values.filter(v.isNotNull() & ~F.isnan(v) & (v != F.col(nodata)))


def fill_missing_time(tiles: DataFrame, time_id: int) -> DataFrame:
    """``SET fk_time_id = x WHERE fk_time_id IS NULL``."""
    return tiles.withColumn("fk_time_id", F.coalesce(F.col("fk_time_id"), F.lit(time_id).cast("bigint")))


def time_filter(tiles: DataFrame, time_id: int) -> DataFrame:
    """Tiles of one time id (partition column -> partition pruning)."""
    return tiles.filter(F.col("fk_time_id") == time_id)


def srid_check(df: DataFrame, srid_col: str = "srid") -> DataFrame:
    """All rows must carry one SRID -> ``(srid, n_rows, consistent)``."""
    return df.agg(F.min(srid_col).alias("srid"), F.count(F.lit(1)).alias("n_rows"),
                  (F.min(srid_col) == F.max(srid_col)).alias("consistent"))


def mosaic(layers: DataFrame) -> DataFrame:
    """``ST_Union`` with the default LAST rule: per pixel the valid value
    of the layer with the highest ``rid`` wins (``max_by``; partial
    aggregation keeps a hot pixel range from concentrating)."""
    return layers.groupBy("col", "row").agg(F.max_by("value", "rid").alias("value"),
                                           F.max("rid").alias("rid"))


def mosaic_tiles(tiles: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """A8 on tiles: the tiles of one position and time become one, per pixel
    the valid value of the highest ``rid``.  Partitioned by tile position
    (a group is the layers that overlap there), which the zonal join reuses."""
    def over(below, above):
        return F.zip_with(below, above, lambda b, a: F.when((a == F.col("nodata")) | F.isnan(a) | a.isNull(), b).otherwise(a))

    first = [c for c in tiles.columns if c not in ("rid", "pixels", "fk_time_id", "tile_col", "tile_row", *keys)]
    g = (tiles.repartition("tile_col", "tile_row").groupBy(*keys, "fk_time_id", "tile_col", "tile_row")
         .agg(F.array_sort(F.collect_list(F.struct("rid", "pixels"))).alias("_layers"), *[F.first(c).alias(c) for c in first]))
    pixels = F.aggregate(F.slice("_layers", 2, F.greatest(F.size("_layers") - 1, F.lit(0))), F.col("_layers")[0]["pixels"], lambda acc, x: over(acc, x["pixels"]))
    return g.select(F.element_at("_layers", -1)["rid"].alias("rid"), *keys, "fk_time_id", "tile_col", "tile_row", *first, pixels.alias("pixels"))


def overview_pyramid(tiles: DataFrame, levels: int, pyramid_tile: int = 2048) -> DataFrame:
    """Image pyramid as a tile table.  Level L averages 2x2 blocks of level
    L-1 (bilinear at an exact factor of 2 is the block mean; nodata does not
    count).

    Tiles in, tiles out, no pixel rows: every tile shrinks to a quarter where it
    lies, and only the quarters are shuffled, four to a parent tile.  Tiles have
    even sides.  ``block_col, block_row``: the image of ``pyramid_tile`` pixels a
    side that the tile belongs to."""
    cur = tiles.select("fk_time_id", "tile_col", "tile_row", "width", "height", F.col("nodata").cast("double").alias("nodata"), F.col("pixels").cast("array<double>").alias("pixels"))
    out = []
    for lvl in range(1, levels + 1):
        cur = materialize(_parents(cur), f"pyramid-{lvl}")
        out.append(cur.withColumn("level", F.lit(lvl)))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    block = lambda at, side: (F.col(at) * F.col(side) / pyramid_tile).cast("bigint")
    return res.select("level", "fk_time_id", "tile_col", "tile_row", "width", "height", "nodata", block("tile_col", "width").alias("block_col"), block("tile_row", "height").alias("block_row"), "pixels")


def _parents(tiles: DataFrame) -> DataFrame:
    """Parent tiles of half the resolution."""
    w, h, nodata, pixels = F.col("width"), F.col("height"), F.col("nodata"), F.col("pixels")
    half_w, half_h = (w / 2).cast("int"), (h / 2).cast("int")

    def shrunk(k: Column) -> Column:
        first = (k / half_w).cast("int") * 2 * w + (k % half_w) * 2
        four = F.filter(F.array(*[F.get(pixels, (first + step).cast("int")) for step in (F.lit(0), F.lit(1), w, w + 1)]), lambda v: (v != nodata) & ~F.isnan(v))
        return F.when(F.size(four) > 0, F.aggregate(four, F.lit(0.0), lambda a, v: a + v) / F.size(four)).otherwise(nodata)

    quarter = F.transform(F.sequence(F.lit(0), half_w * half_h - 1), shrunk)
    small = tiles.select("fk_time_id", F.shiftright("tile_col", 1).alias("tile_col"), F.shiftright("tile_row", 1).alias("tile_row"), "width", "height", "nodata",
                         (F.col("tile_row") % 2 * 2 + F.col("tile_col") % 2).cast("int").alias("at"), quarter.alias("quarter"))
    four = small.groupBy("fk_time_id", "tile_col", "tile_row").agg(F.map_from_entries(F.collect_list(F.struct("at", "quarter"))).alias("q"), *[F.first(c).alias(c) for c in ("width", "height", "nodata")])

    def placed(k: Column) -> Column:
        row, col = (k / w).cast("int"), k % w
        own = F.try_element_at(F.col("q"), ((row / half_h).cast("int") * 2 + (col / half_w).cast("int")).cast("int"))
        return F.coalesce(F.get(own, ((row % half_h) * half_w + col % half_w).cast("int")), nodata)

    return four.select("fk_time_id", "tile_col", "tile_row", "width", "height", "nodata", F.transform(F.sequence(F.lit(0), w * h - 1), placed).alias("pixels"))


def save_tile_table(tiles: DataFrame, table: str, buckets: int, by_time: bool = False) -> DataFrame:
    """Store tiles as a catalog table bucketed and sorted by the tile key (and in
    a folder per time with ``by_time``).

    The zonal join (segments JOIN tiles ON tile_col, tile_row) then reads the
    big side in place and shuffles only the segments into the same buckets."""
    w = tiles.write.mode("overwrite").bucketBy(buckets, "tile_col", "tile_row").sortBy("tile_col", "tile_row")
    (w.partitionBy("fk_time_id") if by_time else w).saveAsTable(table)
    return tiles.sparkSession.table(table)
