import random

import numpy as np
from pyspark.sql import functions as F

from core_helpers import plan_text
from regiostat.functions.geometry import wkt_parse
from regiostat.operators import zonal as Z
from regiostat.operators.raster import Grid, tiles_from_pixels

GRID = Grid(width=40, height=40, tile_w=8, tile_h=8, nodata=-1.0)


def zones(spark, wkts):
    df = spark.createDataFrame([(i, f"Z{i}", w) for i, w in enumerate(wkts)], "gid long, comm_id string, wkt string")
    return df.select("gid", "comm_id", wkt_parse("wkt").alias("geom"))


def brute_inside(rings, w, h):
    """Even-odd test of every pixel centre (numpy)."""
    cx, cy = np.meshgrid(np.arange(w) + 0.5, np.arange(h) + 0.5)
    inside = np.zeros((h, w), bool)
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:]):
            if y1 == y2:
                continue
            cross = (y1 > cy) != (y2 > cy)
            xi = x1 + (cy - y1) * (x2 - x1) / (y2 - y1)
            inside ^= cross & (cx < xi)
    return inside


def test_square_with_hole_47_pixels_10_spans(spark):
    wkt = "POLYGON((1.25 1.25, 9.25 1.25, 9.25 8.25, 1.25 8.25, 1.25 1.25),(3.25 3.25, 6.25 3.25, 6.25 6.25, 3.25 6.25, 3.25 3.25))"
    sp = Z.zone_spans(Z.zone_edges(zones(spark, [wkt])), GRID).collect()
    assert len(sp) == 10
    assert sum(r.col_to - r.col_from + 1 for r in sp) == 47


def test_spans_match_brute_force(spark):
    rnd = random.Random(7)
    wkts, rings = [], []
    for _ in range(6):
        n = rnd.randint(3, 7)
        cx, cy = rnd.uniform(10, 30), rnd.uniform(10, 30)
        pts = []
        for k in range(n):
            a = 2 * np.pi * k / n + rnd.uniform(0, 0.5)
            r = rnd.uniform(3, 9)
            pts.append((round(cx + r * np.cos(a), 3) + 0.0001, round(cy + r * np.sin(a), 3) + 0.0001))
        pts.append(pts[0])
        rings.append(pts)
        wkts.append("POLYGON((" + ", ".join(f"{x} {y}" for x, y in pts) + "))")
    sp = Z.zone_spans(Z.zone_edges(zones(spark, wkts)), GRID).collect()
    for gid, ring in enumerate(rings):
        want = brute_inside([ring], GRID.width, GRID.height)
        got = np.zeros_like(want)
        for r in sp:
            if r.gid == gid:
                got[r.row, r.col_from:r.col_to + 1] = True
        assert (got == want).all(), gid


def test_zonal_stats_nodata_and_empty_zone(spark):
    pix = [(1, c, r, float(c + r) if (c + r) % 5 else -1.0) for c in range(16) for r in range(16)]
    pixels = spark.createDataFrame(pix, "fk_time_id long, col long, row long, value double")
    tiles = tiles_from_pixels(pixels, GRID)
    z = zones(spark, ["POLYGON((0.25 0.25, 4.25 0.25, 4.25 4.25, 0.25 4.25, 0.25 0.25))",
                      "POLYGON((30.25 30.25, 31.25 30.25, 31.25 31.25, 30.25 30.25))"])
    res = {r.comm_id: r for r in Z.zonal_stats(z, tiles, GRID, [1]).collect()}
    vals = [c + r for c in range(4) for r in range(4) if (c + r) % 5]
    assert res["Z0"]["count"] == len(vals)
    assert float(res["Z0"]["sum"]) == sum(vals)
    assert float(res["Z0"]["max"]) == max(vals)
    assert res["Z1"]["count"] is None and res["Z1"]["mean"] is None


def test_tile_join_plan_is_equi_join(spark):
    pix = [(1, c, r, 1.0) for c in range(16) for r in range(16)]
    tiles = tiles_from_pixels(spark.createDataFrame(pix, "fk_time_id long, col long, row long, value double"), GRID)
    z = zones(spark, ["POLYGON((0.25 0.25, 9.25 0.25, 9.25 9.25, 0.25 0.25))"])
    df = Z.zonal_stats(z, tiles, GRID, [1])
    df.collect()
    p = plan_text(df)
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p and "BatchEvalPython" not in p


def test_tiles_dense_and_roundtrip(spark):
    from regiostat.operators.raster import tile_pixels
    pix = [(1, 3, 2, 7.0), (1, 9, 9, 5.0)]
    t = tiles_from_pixels(spark.createDataFrame(pix, "fk_time_id long, col long, row long, value double"), GRID)
    rows = {(r.tile_col, r.tile_row): r for r in t.collect()}
    assert len(rows[(0, 0)].pixels) == 64 and rows[(0, 0)].pixels[2 * 8 + 3] == 7.0
    assert rows[(0, 0)].pixels.count(-1.0) == 63
    back = sorted(tuple(r) for r in tile_pixels(t).select("col", "row", "value").collect())
    assert back == [(3, 2, 7.0), (9, 9, 5.0)]


def test_bucketed_tiles_are_not_shuffled(spark):
    from regiostat.operators.raster import save_tile_table
    pix = [(1, c, r, float(c)) for c in range(40) for r in range(40)]
    tiles = tiles_from_pixels(spark.createDataFrame(pix, "fk_time_id long, col long, row long, value double"), GRID)
    stored = save_tile_table(tiles, "test_tiles_bucketed", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        z = zones(spark, ["POLYGON((0.25 0.25, 30.25 0.25, 30.25 30.25, 0.25 0.25))"])
        df = Z.zone_values(z, stored, GRID)
        n = df.count()
        p = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert n > 0
    tile_side = [line for line in p.splitlines() if "test_tiles_bucketed" in line or "Bucketed: true" in line]
    assert tile_side, p
    # the tile scan feeds the join without an exchange of its own
    lines = p.splitlines()
    scan = next(i for i, l in enumerate(lines) if "FileScan" in l and "pixels" in l)
    assert "Exchange" not in lines[scan - 1] and "Exchange" not in lines[scan - 2], p
