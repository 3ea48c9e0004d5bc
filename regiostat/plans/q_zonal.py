"""Geometry, raster and zonal queries (stage 4) and the flagship pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiostat.functions import geometry as G
from regiostat.operators import hierarchy as H
from regiostat.operators import raster as RA
from regiostat.operators import zonal as Z
from regiostat.plans.fixture_sql import CTES, scaled_zonal_body, with_ctes
from regiostat.plans.fixtures import Fixtures
from regiostat.plans.q_hierarchy import all_levels_sql
from regiostat.plans.registry import register
from regiostat.session import materialize

TIMES = [1, 2]


# -- geometry ------------------------------------------------------------------
@register("wkt_parse", with_ctes(["zvert"], "SELECT gid, part, ring, seq, x, y FROM zvert"))
def q_wkt_parse(spark, sf):
    return Z.zone_vertices(Fixtures(spark, sf).zones())


@register("ewkt_parse", with_ctes(["zvert"], """
SELECT gid, CAST(3035 AS INTEGER) AS srid, 'POLYGON' AS type, count(*) AS n_vertices FROM zvert GROUP BY gid"""))
def q_ewkt_parse(spark, sf):
    z = Fixtures(spark, sf).zone_wkt().select("gid", G.ewkt_parse(F.concat(F.lit("SRID=3035;"), "wkt")).alias("g"))
    return z.select("gid", F.col("g.srid").alias("srid"), F.col("g.type").alias("type"),
                    G.num_vertices("g").cast("bigint").alias("n_vertices"))


@register("wkt_format", with_ctes(["zwkt"], "SELECT gid, wkt FROM zwkt"))
def q_wkt_format(spark, sf):
    return Fixtures(spark, sf).zones().select("gid", G.wkt_format("geom").alias("wkt"))


@register("force_multi", with_ctes(["zvert"], """
SELECT gid, 'MULTIPOLYGON' AS type, CAST(1 AS INTEGER) AS n_parts, CAST(count(DISTINCT ring) AS INTEGER) AS n_rings
FROM zvert GROUP BY gid"""))
def q_force_multi(spark, sf):
    z = Fixtures(spark, sf).zones().select("gid", G.force_multi("geom").alias("g"))
    return z.select("gid", F.col("g.type").alias("type"), F.size("g.parts").alias("n_parts"),
                    F.size(F.col("g.parts")[0]).alias("n_rings"))


def _laea_sql() -> str:
    k = G.laea_constants()
    e2, e, qp, b0, rq, d, lon0 = k["e2"], k["e"], k["qp"], k["beta0"], k["rq"], k["d"], k["lon0"]
    q = (f"(1 - {e2!r}) * (sin(radians(lat)) / (1 - {e2!r} * sin(radians(lat)) * sin(radians(lat))) "
         f"- {1 / (2 * e)!r} * ln((1 - {e!r} * sin(radians(lat))) / (1 + {e!r} * sin(radians(lat)))))")
    beta = f"asin({q} / {qp!r})"
    dl = f"(radians(lon) - {lon0!r})"
    import math
    sb0, cb0 = math.sin(b0), math.cos(b0)
    b = f"({rq!r} * sqrt(2 / (1 + {sb0!r} * sin(b) + {cb0!r} * cos(b) * cos(dl))))"
    east = f"4321000.0 + {b} * {d!r} * cos(b) * sin(dl)"
    north = f"3210000.0 + ({b} / {d!r}) * ({cb0!r} * sin(b) - {sb0!r} * cos(b) * cos(dl))"
    return with_ctes(["lonlat"], f"""
SELECT gid, CAST({east} AS DECIMAL(20,3)) AS e, CAST({north} AS DECIMAL(20,3)) AS n
FROM (SELECT gid, {beta} AS b, {dl} AS dl FROM lonlat)""")


@register("reproject_laea", _laea_sql())
def q_reproject_laea(spark, sf):
    p = Fixtures(spark, sf).lonlat()
    e, n = G.laea_project("lon", "lat")
    return p.select("gid", e.cast("decimal(20,3)").alias("e"), n.cast("decimal(20,3)").alias("n"))


@register("bbox", with_ctes(["zvert"], "SELECT gid, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax "
                                       "FROM zvert GROUP BY gid"))
def q_bbox(spark, sf):
    return Fixtures(spark, sf).zones().select("gid", G.bbox("geom").alias("b")).select("gid", "b.*")


@register("edges", with_ctes(["zedge"], "SELECT gid, part, ring, seq, x1, y1, x2, y2 FROM zedge"))
def q_edges(spark, sf):
    return Z.zone_edges(Fixtures(spark, sf).zones())


SPANS_SQL = with_ctes(["inside"], """
SELECT gid, row, min(col) AS col_from, max(col) AS col_to FROM (
  SELECT gid, row, col, col - row_number() OVER (PARTITION BY gid, row ORDER BY col) AS grp FROM inside)
GROUP BY gid, row, grp""")


@register("zone_spans", SPANS_SQL)
def q_zone_spans(spark, sf):
    fx = Fixtures(spark, sf)
    return Z.zone_spans(Z.zone_edges(fx.zones()), fx.scaled_grid())


@register("tile_zone_join", with_ctes(["inside", "tilekeys"], """
SELECT DISTINCT i.gid, t.fk_time_id, t.tile_col, t.tile_row FROM inside i
JOIN tilekeys t ON t.tile_col = i.col // 32 AND t.tile_row = i.row // 32"""))
def q_tile_zone_join(spark, sf):
    fx = Fixtures(spark, sf)
    seg = Z.tile_segments(Z.zone_spans(Z.zone_edges(fx.zones()), fx.scaled_grid()), fx.scaled_grid())
    t = fx.tiles().select("tile_col", "tile_row", "fk_time_id")
    return seg.join(t, ["tile_col", "tile_row"]).select("gid", "fk_time_id", "tile_col", "tile_row").distinct()


@register("raster_clip", with_ctes(["clip"], "SELECT gid, fk_time_id, col, row, value FROM clip"))
def q_raster_clip(spark, sf):
    fx = Fixtures(spark, sf)
    return Z.zone_values(fx.zones(), fx.tiles(), fx.scaled_grid(), mask_nodata=False)


@register("nodata_mask", with_ctes(["clip"], "SELECT gid, fk_time_id, col, row, value FROM clip "
                                            "WHERE value <> -9999.0 AND NOT isnan(value)"))
def q_nodata_mask(spark, sf):
    fx = Fixtures(spark, sf)
    return Z.zone_values(fx.zones(), fx.tiles(), fx.scaled_grid())


# -- raster ----------------------------------------------------------------------
TILE_SUMMARY = """
SELECT fk_time_id, col // 32 AS tile_col, row // 32 AS tile_row,
  CAST(count(*) FILTER (WHERE value <> -9999.0) AS BIGINT) AS n_valid,
  CAST(1024 - count(*) FILTER (WHERE value <> -9999.0) AS BIGINT) AS n_nodata,
  sum(value) FILTER (WHERE value <> -9999.0) AS sum_valid,
  sum(((row % 32) * 32 + col % 32 + 1) * value) FILTER (WHERE value <> -9999.0) AS checksum
FROM px GROUP BY 1, 2, 3"""


@register("raster_tile_ingest", with_ctes(["px"], TILE_SUMMARY))
def q_raster_tile_ingest(spark, sf):
    t = Fixtures(spark, sf).tiles()
    valid = lambda v: (v != F.col("nodata")) & ~F.isnan(v)
    pos = F.sequence(F.lit(1), F.size("pixels"))
    return t.select(
        "fk_time_id", "tile_col", "tile_row",
        F.size(F.filter("pixels", valid)).cast("bigint").alias("n_valid"),
        F.size(F.filter("pixels", lambda v: ~valid(v))).cast("bigint").alias("n_nodata"),
        F.aggregate(F.filter("pixels", valid), F.lit(0.0), lambda a, v: a + v).alias("sum_valid"),
        F.aggregate(F.filter(F.arrays_zip(pos.alias("i"), F.col("pixels").alias("v")), lambda s: valid(s["v"])),
                    F.lit(0.0), lambda a, s: a + s["i"] * s["v"]).alias("checksum"))


@register("srid_tag", with_ctes(["tilekeys"], """
SELECT CAST(3035 AS INTEGER) AS srid, count(*) AS n_rows, true AS consistent FROM tilekeys"""))
def q_srid_tag(spark, sf):
    return RA.srid_check(Fixtures(spark, sf).tiles())


@register("time_filter", with_ctes(["tilekeys"], "SELECT tile_col, tile_row FROM tilekeys WHERE fk_time_id = 2"))
def q_time_filter(spark, sf):
    return RA.time_filter(Fixtures(spark, sf).tiles(), 2).select("tile_col", "tile_row")


@register("fill_missing_time", with_ctes(["tilekeys"], """
SELECT fk_time_id, count(*) AS n_tiles FROM tilekeys GROUP BY fk_time_id"""))
def q_fill_missing_time(spark, sf):
    t = Fixtures(spark, sf).tiles()
    t = t.withColumn("fk_time_id", F.when(F.col("fk_time_id") == 1, F.col("fk_time_id")))  # layer 2 untagged
    t = RA.fill_missing_time(t, 2)
    return t.groupBy("fk_time_id").agg(F.count(F.lit(1)).alias("n_tiles"))


@register("add_missing_column", with_ctes(["px"], """
SELECT CASE WHEN fk_time_id = 1 THEN fk_time_id END AS fk_time_id, count(*) AS n FROM px GROUP BY 1"""))
def q_add_missing_column(spark, sf):
    from regiostat.operators.tabular import add_missing_column
    fx = Fixtures(spark, sf)
    old = fx.pixels_layer(1)
    new = add_missing_column(fx.pixels_layer(2).drop("fk_time_id"), "fk_time_id", "bigint")
    return old.unionByName(new).groupBy("fk_time_id").agg(F.count(F.lit(1)).alias("n"))


@register("mosaic", with_ctes(["px"], """
SELECT col, row, arg_max(value, fk_time_id) AS value, max(fk_time_id) AS rid
FROM px WHERE value <> -9999.0 GROUP BY col, row"""))
def q_mosaic(spark, sf):
    fx = Fixtures(spark, sf)
    layers = RA.nodata_mask(fx.pixels().withColumn("nodata", F.lit(-9999.0)))
    return RA.mosaic(layers.select("col", "row", "value", F.col("fk_time_id").alias("rid")))


def _pyramid_sql(levels: int = 3) -> str:
    parts, prev = [], "(SELECT fk_time_id, col, row, value FROM px WHERE value <> -9999.0)"
    ctes = []
    for lvl in range(1, levels + 1):
        name = f"lv{lvl}"
        ctes.append(f"{name} AS (SELECT fk_time_id, col // 2 AS col, row // 2 AS row, avg(value) AS value "
                    f"FROM {prev} GROUP BY 1, 2, 3)")
        parts.append(f"SELECT {lvl} AS level, fk_time_id, col, row, col // 2048 AS tile_col, row // 2048 AS tile_row, "
                     f"CAST(value AS DECIMAL(38,6)) AS value FROM {name}")
        prev = name
    body = ", ".join(ctes)
    return with_ctes(["px"], "").replace("\n", "\n", 1).rstrip() + f", {body}\n" + " UNION ALL ".join(parts)


@register("overview_pyramid", _pyramid_sql())
def q_overview_pyramid(spark, sf):
    p = RA.overview_pyramid(Fixtures(spark, sf).tiles(), 3)
    pixels = p.select("level", "fk_time_id", "tile_col", "tile_row", "width", "height", "nodata", F.posexplode("pixels").alias("off", "value"))
    col = F.col("tile_col") * F.col("width") + F.col("off") % F.col("width")
    row = F.col("tile_row") * F.col("height") + (F.col("off") / F.col("width")).cast("bigint")
    pixels = RA.nodata_mask(pixels.select("level", "fk_time_id", col.alias("col"), row.alias("row"), "value", "nodata"))
    return pixels.select("level", "fk_time_id", "col", "row", (F.col("col") / 2048).cast("bigint").alias("tile_col"), (F.col("row") / 2048).cast("bigint").alias("tile_row"),
                         F.col("value").cast("decimal(38,6)").alias("value"))


# -- zonal statistics ---------------------------------------------------------------
ZONAL_COLS = "count, sum, mean, stddev, min, max, comm_id, fk_time_id, fk_lau_gid"


@register("zonal_stats", with_ctes(["zonal"], f"SELECT {ZONAL_COLS} FROM zonal"))
def q_zonal_stats(spark, sf):
    fx = Fixtures(spark, sf)
    return Z.zonal_stats(fx.zones(), fx.tiles(), fx.scaled_grid(), TIMES)


@register("zonal_stats_basic", with_ctes(["zonal"], "SELECT fk_lau_gid, comm_id, fk_time_id, min, max, mean, count "
                                                   "FROM zonal"))
def q_zonal_stats_basic(spark, sf):
    fx = Fixtures(spark, sf)
    return Z.zonal_stats_basic(fx.zones(), fx.tiles(), fx.scaled_grid(), TIMES)


def _zonal_t3_sql() -> str:
    from regiostat.plans.fixture_sql import zonal_body
    sql = with_ctes(["zone_lau", "clip"], "")
    return sql.rstrip() + ",\nzl AS (" + zonal_body([1, 3]) + f")\nSELECT {ZONAL_COLS} FROM zl"


@register("zone_lateral_stats", _zonal_t3_sql())
def q_zone_lateral_stats(spark, sf):
    """Every zone keeps a row per requested time, NULL where a time has
    no pixels (time 3 has no tiles at all)."""
    fx = Fixtures(spark, sf)
    return Z.zonal_stats(fx.zones(), fx.tiles(), fx.scaled_grid(), [1, 3])


def zonal_pipeline(spark, sf):
    """Flagship: pixels -> tiles -> zonal statistics per municipality -> NUTS 3
    -> NUTS 0-2 (one table)."""
    fx = Fixtures(spark, sf)
    grid = fx.scaled_grid()
    stats = materialize(Z.zonal_stats(fx.scaled_zones(), RA.tiles_from_pixels(fx.scaled_pixels(), grid), grid, [1]), "lau_stats")
    return H.rollup_all(stats, materialize(fx.scaled_lau(), "scaled_lau"), fx.nuts())


def _pipeline_sql() -> str:
    return with_ctes(["nuts", "slau", "szonal"], all_levels_sql("szonal", "slau"))


register("zonal_pipeline", _pipeline_sql())(zonal_pipeline)
assert "zonal" in CTES


@register("zonal_stats_scaled", with_ctes(["szonal"], f"SELECT {ZONAL_COLS} FROM szonal"))
def q_zonal_stats_scaled(spark, sf):
    """A1 on a raster and a zone set that both grow with the data: one pixel
    per order, one zone per 32 x 32 block holding orders."""
    fx = Fixtures(spark, sf)
    g = fx.scaled_grid()
    return Z.zonal_stats(fx.scaled_zones(), RA.tiles_from_pixels(fx.scaled_pixels(), g), g, [1])


@register("zonal_stats_layers", with_ctes(["spx_second", "sedge"], scaled_zonal_body("spx_second", 2)))
def q_zonal_stats_layers(spark, sf):
    """A1 + A8 + P13: one of three times is asked for, and a second layer lies
    over part of the first; where both are valid the second counts."""
    fx = Fixtures(spark, sf)
    return Z.zonal_stats(fx.scaled_zones(), fx.layered_tiles(), fx.scaled_grid(), [2], overlaps=True)
