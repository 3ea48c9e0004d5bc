"""Wildcard search by grams, numbering, exact sums, cell cover, tile pyramid,
table replacement."""

import os
import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from core_helpers import plan_text
from regiostat.functions.geometry import wkt_parse
from regiostat.operators import dims as D
from regiostat.operators import raster as RA
from regiostat.operators import recompute as R
from regiostat.operators import zonal as Z
from regiostat.operators.spatial import cell_cover, points_in_polygons
from regiostat.sources import sinks as SK

PIXEL = "fk_time_id long, col long, row long, value double"


def like(pattern: str, code: str) -> bool:
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
            out += re.escape(pattern[i])
        else:
            out += {"%": ".*", "_": "."}.get(c, re.escape(c))
        i += 1
    return re.fullmatch(out, code, re.S) is not None


def test_wildcards_anywhere_against_every_region(spark):
    rng = random.Random(3)
    codes = sorted({"".join(rng.choice("ABC12") for _ in range(rng.randint(1, 6))) for _ in range(150)} | {"A%B", "_X", "\\1"})
    regions = spark.createDataFrame([(100 - i, c) for i, c in enumerate(codes)], "gid long, nuts_id string")
    patterns = ["%12", "_A%", "%", "_", "__%", "%B_", "A%B%1", "______%", "_______%", "%%", "A\\%B", "\\%%", "%\\_X%", "%\\\\1", "%ZZZ%", "a_", "%a1%b", "_%_%_"]
    patterns += ["".join(rng.choice("ABC12%_%_") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    patterns = sorted({p for p in patterns if "%" in p or "_" in p})
    df = D.region_key_like_join(spark.createDataFrame([(p,) for p in patterns], "k string"), "k", regions, vintage=None)
    got = {r.k: r.fk_nuts_gid for r in df.collect()}
    want = {p: min([100 - i for i, c in enumerate(codes) if like(p.upper(), c)], default=None) for p in patterns}
    assert got == {p: g for p, g in want.items() if g is not None}
    assert "NestedLoop" not in plan_text(df) and "Cartesian" not in plan_text(df)


def test_no_gram_is_shared_by_all_regions(spark):
    codes = [f"{a}{b:03d}" for a in "ABCDE" for b in range(100)]
    index = spark.createDataFrame([(c,) for c in codes], "c string").select(F.explode(D._grams(F.concat(F.lit(D._BEGIN), F.col("c"), F.lit(D._END)))).alias("g"))
    wanted = spark.createDataFrame([("%12",), ("_A%",), ("%7_",)], "p string").select("p", F.explode(D.pattern_grams(F.col("p"))).alias("g"))
    sizes = {(r.p, r.g): r["count"] for r in wanted.join(index.groupBy("g").count(), "g").collect()}
    assert sizes["%12", "12" + D._END] == 5  # looks only at codes that end in 12
    assert max(min(n for (p, _), n in sizes.items() if p == q) for q in ("%12", "%7_")) < len(codes) / 2


def test_numbering_joins_a_table_of_offsets(spark):
    df = spark.range(0, 1000, numPartitions=37).filter("id % 3 = 0")
    out = D.serial_id(df, start=5, name="nr")
    rows = out.orderBy("nr").collect()
    assert [r.nr for r in rows] == list(range(5, 5 + len(rows)))
    p = plan_text(out)
    assert "keys: [" not in p and "map_from_arrays" not in p and "Join" in p
    assert D.serial_id(df.limit(0), name="nr").collect() == []


@pytest.mark.parametrize("values, total", [([4e-7] * 10_000, "0.00"), ([1e12, 0.25, -1e12, 0.5] * 100, "75.00"), ([0.1] * 1000, "100.00"), ([1e-7] * 5 + [1e12] * 3, "3000000000000.00"),
                                           ([-0.005] * 3, "-0.02"), ([123456789.125, -0.125, 2 ** -40], "123456789.00")])
def test_sums_are_exact_in_any_order(spark, values, total):
    exact = sum(map(Fraction, values))
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for order in (F.col("v"), F.col("v").desc(), F.rand(1)):
        sums = df.orderBy(order).repartition(3).agg(*[F.sum(x).alias(f"s{i}") for i, x in enumerate(Z.limbs(F.col("v")))])
        got = sums.select(Z.exact_sum([F.col(f"s{i}") for i in range(4)]).alias("x")).first().x
        assert abs(Fraction(got) - exact) < Fraction(1, 10 ** 11)
        assert format(got.quantize(__import__("decimal").Decimal("0.01"), rounding="ROUND_HALF_UP"), "f") == total


def test_tiny_and_huge_pixels_in_one_query(spark):
    grid = RA.Grid(width=64, height=64, tile_w=16, tile_h=16, nodata=-1.0)
    pixels = spark.createDataFrame([(1, c, r, 1e-7 if c < 32 else 1e12) for c in range(64) for r in range(64)], PIXEL)
    square = "POLYGON(({0} 0.25, {1} 0.25, {1} 63.75, {0} 63.75, {0} 0.25))"
    z = spark.createDataFrame([(1, "A", square.format(0.25, 31.75)), (2, "B", square.format(32.25, 63.75)), (3, "C", square.format(0.25, 63.75))], "gid long, comm_id string, wkt string")
    z = z.select("gid", "comm_id", wkt_parse("wkt").alias("geom"))
    got = {r.comm_id: (r["count"], str(r["sum"])) for r in Z.zonal_stats(z, RA.tiles_from_pixels(pixels, grid), grid, [1]).collect()}
    n = got["A"][0]
    assert got == {"A": (n, "0.00"), "B": (n, f"{n * 10 ** 12}.00"), "C": (2 * n, f"{n * 10 ** 12}.00")}


def polygon(rng, x, y, r, n):
    import math
    pts = [(x + r * rng.uniform(0.5, 1) * math.cos(2 * math.pi * k / n), y + r * rng.uniform(0.5, 1) * math.sin(2 * math.pi * k / n)) for k in range(n)]
    return list(zip(pts, pts[1:] + pts[:1]))


def test_cell_cover_against_every_polygon(spark):
    rng = random.Random(11)
    shapes = {0: polygon(rng, 0, 0, 400, 9), 1: polygon(rng, 30, -20, 15, 30), 2: [((0, 0), (8, 0)), ((8, 0), (8, 8)), ((8, 8), (0, 8)), ((0, 8), (0, 0)), ((2, 2), (2, 6)), ((2, 6), (6, 6)), ((6, 6), (6, 2)), ((6, 2), (2, 2))]}
    edges = spark.createDataFrame([(z, *map(float, (*a, *b))) for z, s in shapes.items() for a, b in s], "zone long, x1 double, y1 double, x2 double, y2 double")
    pts = [(i, rng.uniform(-420, 420), rng.uniform(-420, 420)) for i in range(400)] + [(1000 + i, rng.uniform(-3, 50), rng.uniform(-40, 12)) for i in range(400)] + [(2000 + i, float(i % 10), float(i // 10)) for i in range(100)]
    got = {tuple(r) for r in points_in_polygons(spark.createDataFrame(pts, "pid long, x double, y double"), edges, 4.0).collect()}

    def inside(s, x, y):
        return sum((a[1] > y) != (b[1] > y) and x < a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) for a, b in s) % 2 == 1
    assert got == {(i, z) for i, x, y in pts for z, s in shapes.items() if inside(s, x, y)}
    n = cell_cover(edges.filter("zone = 0"), 4.0).count()
    assert n < 16 * 4 * 400 / 4  # in proportion to the border; its box has 40,000 cells


def test_pyramid_of_tiles_against_blocks_of_pixels(spark):
    rng = random.Random(5)
    value = {(t, c, r): float(rng.randint(0, 50)) for t in (1, 2) for c in range(70) for r in range(41) if rng.random() < 0.4}
    grid = RA.Grid(width=70, height=41, tile_w=8, tile_h=8, nodata=-9.0)
    tiles = RA.tiles_from_pixels(spark.createDataFrame([(*k, v) for k, v in value.items()], PIXEL), grid)
    got = {}
    for r in RA.overview_pyramid(tiles, 4).collect():
        assert len(r.pixels) == 64
        got |= {(r.level, r.fk_time_id, r.tile_col * 8 + k % 8, r.tile_row * 8 + k // 8): v for k, v in enumerate(r.pixels) if v != -9.0}
    want, level = {}, value
    for lvl in range(1, 5):
        blocks = {}
        for (t, c, r), v in level.items():
            blocks.setdefault((t, c // 2, r // 2), []).append(v)
        level = {k: sum(v) / len(v) for k, v in blocks.items()}
        want |= {(lvl, *k): v for k, v in level.items()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_only_geometries_that_differ_are_changes(spark):
    square = "POLYGON((0 0, 4 0, 4 {0}, 0 {0}, 0 0))"
    old = spark.createDataFrame([(i, f"C{i}", square.format(4)) for i in range(6)], "gid long, comm_id string, wkt string").select("gid", "comm_id", wkt_parse("wkt").alias("geom"))
    new = spark.createDataFrame([(f"C{i}", square.format(4 + i % 2)) for i in range(1, 9)], "comm_id string, wkt string").select("comm_id", wkt_parse("wkt").alias("geom"))
    assert sorted(r.comm_id for r in R.changed_zones(old, new).collect()) == ["C1", "C3", "C5"]


def test_a_replace_that_stopped_between_its_moves_loses_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    SK.table_replace(spark.range(4).toDF("id"), path)
    os.rename(path, f"{path}.previous")  # as after the first move
    assert SK.recover_table(spark, path) and spark.read.parquet(path).count() == 4
    os.rename(path, f"{path}.previous")
    SK.table_replace(spark.range(7).toDF("id"), path)
    assert spark.read.parquet(path).count() == 7 and not os.path.exists(f"{path}.previous")


def test_raster_package_with_bucketed_tiles_and_zones_off_the_grid(spark, tmp_path):
    from regiostat.plans.pipelines import integrate_raster_package
    grid = RA.Grid(width=64, height=64, tile_w=16, tile_h=16, nodata=-1.0)
    pixels = spark.createDataFrame([(None, c, r, 2.0) for c in range(64) for r in range(64)], PIXEL)
    square = "POLYGON((0.25 0.25, 9.25 0.25, 9.25 9.25, 0.25 9.25, 0.25 0.25))"
    z = spark.createDataFrame([(1, "A", square, 3035), (2, "B", square, 25832)], "gid long, comm_id string, wkt string, srid int")
    z = z.select("gid", "comm_id", F.when(F.col("srid") == 3035, wkt_parse("wkt", 3035)).otherwise(wkt_parse("wkt", 25832)).alias("geom"))
    lau = spark.createDataFrame([(1, "A", 7, "AA11"), (2, "B", 7, "AA11")], "gid long, comm_id string, fk_nuts_gid long, nuts_id string")
    nuts = spark.createDataFrame([(7, "AA11", 3), (6, "AA1", 2)], "gid long, nuts_id string, stat_levl_ int").withColumn("year", F.lit("2013-01-01").cast("date"))
    out = integrate_raster_package([pixels], {"name": "r"}, grid, z, lau, nuts, None, str(tmp_path), pyramid_levels=1, tile_table="round3_tiles", buckets=4)
    got = {r.comm_id: r["count"] for r in spark.read.parquet(out.tables["lau_stats"]).collect()}
    assert got == {"A": 81, "B": None}
    assert [(r.dataset, r.n_messages) for r in out.issues.collect()] == [("r", 1)]
    assert spark.table("round3_tiles").count() == 16
