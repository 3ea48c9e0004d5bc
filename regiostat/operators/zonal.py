"""Zonal statistics: raster pixels per region polygon.

Plan shape, all equi-joins and bounded groups:

1. polygon -> edges (row-local array work, no shuffle)
2. edges -> scan-line crossings per pixel row -> spans
   ``(zone, row, col_from, col_to)`` of pixel centres inside (even-odd rule,
   so holes and multi-parts work); one small group per (zone, row)
3. spans -> per-tile segments; segments JOIN tiles on the tile key
4. slice each tile row segment, explode only the pixels inside, drop nodata
5. group by (zone, time) with map-side partial aggregation, then keep the
   zones without pixels by a left join (``SELECT (subquery).* FROM lau``)

Work per zone is proportional to its height in pixel rows for the spans and
to its pixel count for the values; no polygon-by-pixel product is formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat.config import DEFAULT_SRID, STAT_DECIMAL
from regiostat.functions.decimals import double_to_stat, to_stat
from regiostat.functions.geometry import transform_to_laea
from regiostat.operators.raster import Grid, mosaic_tiles, nodata_mask

PARTS_TYPE = "array<array<array<struct<x:double,y:double>>>>"
LAU_STAT_COLUMNS = ["count", "sum", "mean", "stddev", "min", "max"]


def zone_vertices(zones: DataFrame, geom: str = "geom", ids: tuple[str, ...] = ("gid",)) -> DataFrame:
    """Vertex table ``(ids, part, ring, seq, x, y)``."""
    z = zones.select(*ids, F.posexplode_outer(F.col(geom)["parts"]).alias("part", "rings"))
    z = z.filter(F.col("rings").isNotNull()).select(*ids, "part", F.posexplode("rings").alias("ring", "pts"))
    z = z.select(*ids, "part", "ring", F.posexplode("pts").alias("seq", "p"))
    return z.select(*ids, "part", "ring", "seq", F.col("p.x").alias("x"), F.col("p.y").alias("y"))


def zone_edges(zones: DataFrame, geom: str = "geom", ids: tuple[str, ...] = ("gid",)) -> DataFrame:
    """Edge table ``(ids, part, ring, seq, x1, y1, x2, y2)``; consecutive
    vertices of each (closed) ring, built inside the row."""
    # outer explode on the geometry column: an inner one makes the optimizer
    # infer a filter on the parsed geometry and push it below the zone
    # table's own aggregations, re-parsing per source row
    z = zones.select(*ids, F.posexplode_outer(F.col(geom)["parts"]).alias("part", "rings"))
    z = z.filter(F.col("rings").isNotNull()).select(*ids, "part", F.posexplode("rings").alias("ring", "pts"))
    pairs = F.when(F.size("pts") > 1, F.transform(
        F.sequence(F.lit(1), F.size("pts") - 1),
        lambda i: F.struct(F.element_at("pts", i).alias("a"), F.element_at("pts", i + 1).alias("b"))))
    e = z.select(*ids, "part", "ring", F.posexplode(pairs).alias("seq", "e"))
    return e.select(*ids, "part", "ring", "seq", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"),
                    F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"))


def zone_spans(edges: DataFrame, grid: Grid, ids: tuple[str, ...] = ("gid",)) -> DataFrame:
    """Pixel-centre spans ``(ids, row, col_from, col_to)`` inside each zone.

    Centre rule, half-open: row r is crossed by an edge when
    ``min(y) <= r+0.5 < max(y)`` (pixel space), and a pair of crossings
    ``xa < xb`` covers columns ``ceil(xa-0.5) .. ceil(xb-0.5)-1``.
    Horizontal edges never cross; a shared vertex counts once.
    """
    px1 = (F.col("x1") - grid.ulx) / grid.scale_x
    px2 = (F.col("x2") - grid.ulx) / grid.scale_x
    py1 = (F.col("y1") - grid.uly) / grid.scale_y
    py2 = (F.col("y2") - grid.uly) / grid.scale_y
    e = edges.select(*ids, px1.alias("px1"), py1.alias("py1"), px2.alias("px2"), py2.alias("py2")).filter(
        F.col("py1") != F.col("py2"))
    r0 = F.greatest(F.ceil(F.least("py1", "py2") - 0.5), F.lit(0))
    r1 = F.least(F.ceil(F.greatest("py1", "py2") - 0.5) - 1, F.lit(grid.height - 1))
    e = e.select("*", r0.alias("r0"), r1.alias("r1")).filter(F.col("r0") <= F.col("r1"))
    rows = e.select(*ids, "px1", "py1", "px2", "py2", F.explode(F.sequence("r0", "r1")).alias("row"))
    xc = F.col("px1") + (F.col("row") + 0.5 - F.col("py1")) * (F.col("px2") - F.col("px1")) / (
        F.col("py2") - F.col("py1"))
    cross = rows.select(*ids, "row", xc.alias("xc"))
    per_row = cross.groupBy(*ids, "row").agg(F.array_sort(F.collect_list("xc")).alias("xs"))
    pairs = F.transform(F.sequence(F.lit(0), (F.size("xs") / 2).cast("int") - 1),
                        lambda k: F.struct(F.element_at("xs", k * 2 + 1).alias("xa"),
                                           F.element_at("xs", k * 2 + 2).alias("xb")))
    sp = per_row.filter(F.size("xs") >= 2).select(*ids, "row", F.explode(pairs).alias("s"))
    c0 = F.greatest(F.ceil(F.col("s.xa") - 0.5), F.lit(0))
    c1 = F.least(F.ceil(F.col("s.xb") - 0.5) - 1, F.lit(grid.width - 1))
    return (sp.select(*ids, "row", c0.alias("col_from"), c1.alias("col_to"))
            .filter(F.col("col_from") <= F.col("col_to")))


def tile_segments(spans: DataFrame, grid: Grid, ids: tuple[str, ...] = ("gid",)) -> DataFrame:
    """Spans cut at tile borders -> ``(ids, tile_col, tile_row, row, c0,
    start, len)``; the tile key is the equi-join key to the tile table."""
    tw, th = grid.tile_w, grid.tile_h
    s = spans.select(*ids, "row", "col_from", "col_to",
                     (F.col("row") / th).cast("bigint").alias("tile_row"),
                     F.explode(F.sequence((F.col("col_from") / tw).cast("bigint"),
                                          (F.col("col_to") / tw).cast("bigint"))).alias("tile_col"))
    c0 = F.greatest("col_from", F.col("tile_col") * tw)
    c1 = F.least("col_to", F.col("tile_col") * tw + (tw - 1))
    return s.select(*ids, "tile_col", "tile_row", "row", c0.alias("c0"),
                    ((F.col("row") - F.col("tile_row") * th) * tw + (c0 - F.col("tile_col") * tw)).cast("int")
                    .alias("start"), (c1 - c0 + 1).cast("int").alias("len"))


def clip_values(segments: DataFrame, tiles: DataFrame, ids: tuple[str, ...] = ("gid",),
                mask_nodata: bool = True, keys: tuple[str, ...] = ()) -> DataFrame:
    """G9 (+G10): pixel values inside each zone, ``(ids, keys, fk_time_id, col,
    row, value)``.  Only the slice of each tile row that lies in a span is
    exploded.  ``keys``: more columns of the tiles (``dataset``)."""
    t = tiles.select("tile_col", "tile_row", *keys, "fk_time_id", "pixels", "nodata")
    j = segments.join(t, ["tile_col", "tile_row"])
    v = j.select(*ids, *keys, "fk_time_id", "row", "c0", "nodata",
                 F.posexplode(F.slice("pixels", F.col("start") + 1, F.col("len"))).alias("k", "value"))
    v = v.select(*ids, *keys, "fk_time_id", (F.col("c0") + F.col("k")).alias("col"), "row", "value", "nodata")
    if mask_nodata:
        v = nodata_mask(v)
    return v.drop("nodata")


def to_grid(geom: str, grid: Grid):
    """Zone geometry in the grid's reference system: unchanged when it says
    nothing or says the same, projected (G5) from geographic coordinates when
    the grid is EPSG:3035, without parts (no pixels) otherwise."""
    g = F.col(geom)
    same = g["srid"].isNull() | (g["srid"] == grid.srid)
    if grid.srid != DEFAULT_SRID:
        return F.when(same, g).otherwise(F.struct(g["srid"].alias("srid"), g["type"].alias("type"), F.lit(None).cast(PARTS_TYPE).alias("parts")))
    return F.when(same, g).otherwise(transform_to_laea(g))


def off_grid(zones: DataFrame, grid: Grid, geom: str = "geom") -> DataFrame:
    """Zones whose geometry can't be brought to the grid's reference system: they
    are measured as zones without pixels."""
    return zones.filter(F.col(geom)["parts"].isNotNull() & to_grid(geom, grid)["parts"].isNull())


def zone_values(zones: DataFrame, tiles: DataFrame, grid: Grid, geom: str = "geom",
                ids: tuple[str, ...] = ("gid",), mask_nodata: bool = True, keys: tuple[str, ...] = ()) -> DataFrame:
    spans = zone_spans(zone_edges(zones, geom, ids), grid, ids)
    return clip_values(tile_segments(spans, grid, ids), tiles, ids, mask_nodata, keys)


def zonal_stats(zones: DataFrame, tiles: DataFrame, grid: Grid, time_ids: list[int],
                geom: str = "geom", ids: tuple[str, ...] = ("gid", "comm_id"), overlaps: bool = False,
                datasets: list[str] | None = None) -> DataFrame:
    """A1 + J9: per zone and time: count, sum, mean, stddev (population),
    min, max of valid pixels, stored as ``decimal(20,2)``; zones without
    pixels keep a row with NULL statistics for every requested time.

    Only tiles of ``time_ids`` are read; zones in geographic coordinates are
    projected to the grid; with ``overlaps`` the layers of a time are united
    first (A8), so no position counts twice.  Sums are exact and do not depend
    on the order of the rows (:func:`exact_sum`).  With ``datasets`` the tiles
    have a column ``dataset``, and all of them are measured in one pass over
    the spans, one row per zone, dataset and time."""
    keys = ("dataset",) if datasets is not None else ()
    wanted = tiles.filter(F.col("fk_time_id").isin([int(t) for t in time_ids]))
    if datasets is not None:
        wanted = wanted.filter(F.col("dataset").isin(datasets))
    own = zones.select(*ids, to_grid(geom, grid).alias(geom))
    vals = zone_values(own, mosaic_tiles(wanted, keys) if overlaps else wanted, grid, geom, ids, keys=keys)
    sums = limbs(F.col("value"))
    agg = vals.groupBy(*ids, *keys, "fk_time_id").agg(
        F.count(F.lit(1)).alias("count"), *[F.sum(x).alias(f"_s{i}") for i, x in enumerate(sums)], double_to_stat(F.stddev_pop("value")).alias("stddev"),
        to_stat(F.min("value")).alias("min"), to_stat(F.max("value")).alias("max"))
    total = exact_sum([F.col(f"_s{i}") for i in range(len(sums))])
    agg = agg.select(*ids, *keys, "fk_time_id", "count", to_stat(total).alias("sum"), (total / F.col("count")).cast("decimal(38,6)").cast(STAT_DECIMAL).alias("mean"), "stddev", "min", "max")
    asked = [F.struct(*[F.lit(d).alias("dataset") for d in ([name] if keys else [])], F.lit(int(t)).cast("bigint").alias("fk_time_id"))
             for name in (datasets or [None]) for t in time_ids]
    grid_rows = zones.select(*ids, F.inline(F.array(*asked)))
    j = grid_rows.join(agg, [*ids, *keys, "fk_time_id"], "left")
    return j.select(*keys, *LAU_STAT_COLUMNS, *[c for c in ids if c != "gid"], "fk_time_id",
                    F.col("gid").alias("fk_lau_gid"))


#: Bits of a limb, and limbs of the fraction: a value is an integer and three
#: numbers of 30 bits behind the point, exact to 2^-90.
LIMB, FRACTION = 30, 3


def limbs(value: Column) -> list[Column]:
    """A double as whole numbers ``i, f1, f2, f3``: ``i + f1/2^30 + f2/2^60 +
    f3/2^90``.  Every step is exact for a double (a difference with its floor,
    a product with a power of two), so sums of limbs are exact in any order;
    what lies below 2^-90 is cut off value by value."""
    out, rest = [F.floor(value)], value - F.floor(value)
    for _ in range(FRACTION):
        rest = rest * float(1 << LIMB)
        out.append(F.floor(rest))
        rest = rest - F.floor(rest)
    return out


def exact_sum(sums: list[Column]) -> Column:
    """Sums of limbs as one ``decimal(38,12)``: carries go up, what is left of
    the fraction (below one) is a double."""
    carry, parts = F.lit(0).cast("bigint"), []
    for x in reversed(sums[1:]):
        whole = x + carry
        carry = F.shiftright(whole, LIMB)
        parts.append(whole - F.shiftleft(carry, LIMB))
    fraction = F.lit(0.0)
    for x in parts:  # the last limb first
        fraction = (fraction + x.cast("double")) / float(1 << LIMB)
    return (sums[0] + carry).cast("decimal(38,12)") + fraction.cast("decimal(38,12)")


def zonal_stats_basic(zones: DataFrame, tiles: DataFrame, grid: Grid, time_ids: list[int],
                      geom: str = "geom") -> DataFrame:
    """Min, max, mean, count per polygon."""
    return zonal_stats(zones, tiles, grid, time_ids, geom).select(
        "fk_lau_gid", "comm_id", "fk_time_id", "min", "max", "mean", "count")
