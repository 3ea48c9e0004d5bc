"""Inputs that the fixtures do not hold: odd texts, files and layers."""

import json
import os

import pytest
from core_helpers import plan_text
from pyspark.sql import functions as F

from regiostat.functions import geometry as G
from regiostat.operators import dims as D
from regiostat.operators import raster as RA
from regiostat.operators import repos as RP
from regiostat.operators import tabular as TB
from regiostat.operators import validate as V
from regiostat.operators import zonal as Z
from regiostat.operators.spatial import points_in_polygons
from regiostat.sources import manifest as M
from regiostat.sources import sinks as SK


@pytest.mark.parametrize("text", ["POLYGON EMPTY", "POINT Z (1 2 3)", "POINT(a b)", "POINT(1)", "notwkt", "GEOMETRYCOLLECTION(POINT(1 2))", "", None])
def test_no_geometry_is_null_parts(spark, text):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(G.wkt_parse("v").alias("g")).first().g.parts is None
    plan = TB.schema_plan([TB.FieldSpec("v", "geometry")])
    acc, rej = TB.reject_rows(TB.typed_projection(df, plan), plan)
    assert (acc.count(), rej.count()) == ((1, 0) if not text else (0, 1))


def test_valid_manifests_are_not_corrupt(spark):
    docs = {"a": '{"profile": "p", "contributors": ["me"], "resources": [{"dialect": {"doubleQuote": "true"}, "temporal": "2015", "unit": null}]}',
            "b": '{"resources": {}}', "c": '{"x": ', "d": '{"contributors": [{"title": "T"}], "resources": [{"temporal": {"start": "2015"}, "schema": {"fields": [{"name": "a", "unit": null, "type": "t"}, {"name": "b"}]}}]}'}
    m = M.manifest_scan(spark.createDataFrame(list(docs.items()), "package string, json string"))
    rows = {r.package: r for r in m.collect()}
    assert [rows[p].corrupt for p in "abcd"] == [False, False, True, False]
    a, d = rows["a"].m.resources[0], rows["d"].m.resources[0]
    assert a.dialect.doubleQuote is True and a.temporal.start is None and "unit" in a["keys"]
    assert d.temporal.start == "2015" and d.fields_complete is False and rows["d"].m.contributors[0].title == "T"


def test_null_is_not_absent_and_suffix_goes_by_case(spark):
    base = {"name": "r.CSV", "path": "data/r.tif", "format": "tif", "unit": None, "raster": {"epsg": None}}
    docs = [("p", json.dumps({"profile": V.RASTER, "resources": [base]}))]
    m = M.manifest_scan(spark.createDataFrame(docs, "package string, json string"))
    listing = spark.createDataFrame([("p/data/r.tif",), ("p/datapackage.json",), ("q/datapackage.json",), ("z/data/x",)], "path string")
    assert V.all_violations(m, M.manifest_resources(m), listing).count() == 0
    packages = spark.createDataFrame([("p",), ("q",), ("z",)], "package string")
    got = {r.package: r.message for r in V.repo_layout_violations(packages, listing).collect()}
    assert got == {"q": V.MSG_NO_DATA, "z": V.MSG_NO_MANIFEST}


GRID = RA.Grid(width=40, height=40, tile_w=8, tile_h=8, nodata=-1.0)
PIXEL = "fk_time_id long, col long, row long, value double"


def test_two_pixels_on_one_position_fail(spark):
    with pytest.raises(Exception, match="two pixels on one position"):
        RA.tiles_from_pixels(spark.createDataFrame([(1, 3, 2, 7.0), (1, 3, 2, 8.0)], PIXEL), GRID).collect()


def test_layers_are_united_and_other_times_not_read(spark):
    lower = RA.tiles_from_pixels(spark.createDataFrame([(t, c, r, 1.0 * t) for t in (1, 2) for c in range(8) for r in range(8)], PIXEL), GRID, layer=1)
    upper = RA.tiles_from_pixels(spark.createDataFrame([(2, 0, 0, 9.0), (2, 1, 0, -1.0)], PIXEL), GRID, layer=2)
    tiles = lower.unionByName(upper)
    assert tiles.select("rid").distinct().count() == 3
    zone = spark.createDataFrame([(1, "Z", "POLYGON((0.25 0.25, 2.25 0.25, 2.25 1.25, 0.25 1.25, 0.25 0.25))")], "gid long, comm_id string, wkt string")
    zone = zone.select("gid", "comm_id", G.wkt_parse("wkt").alias("geom"))
    r = Z.zonal_stats(zone, tiles, GRID, [2], overlaps=True).collect()
    assert [(x["count"], float(x["sum"]), x["fk_time_id"]) for x in r] == [(2, 11.0, 2)]
    stored = tiles.write.mode("overwrite")
    path = os.path.join(spark.conf.get("spark.checkpoint.dir"), "tiles_by_time")
    stored.partitionBy("fk_time_id").parquet(path)
    df = Z.zonal_stats(zone, spark.read.parquet(path), GRID, [2])
    assert "PartitionFilters: [isnotnull(fk_time_id" in plan_text(df) and "IN (2)" in plan_text(df) or "= 2" in plan_text(df)


def test_geographic_zone_is_projected_to_the_grid(spark):
    lon, lat, d = 10.0, 52.0, 0.01
    ring = [(lon - d, lat - d), (lon + d, lat - d), (lon + d, lat + d), (lon - d, lat + d), (lon - d, lat - d)]
    grid = RA.Grid(width=64, height=64, ulx=4321000.0 - 3200, uly=3210000.0 - 3200, scale_x=100.0, scale_y=100.0, tile_w=16, tile_h=16, nodata=-1.0)
    tiles = RA.tiles_from_pixels(spark.createDataFrame([(1, c, r, 1.0) for c in range(64) for r in range(64)], PIXEL), grid)
    wkt = "POLYGON((" + ", ".join(f"{x} {y}" for x, y in ring) + "))"
    zone = spark.createDataFrame([(1, "Z", wkt)], "gid long, comm_id string, wkt string").select("gid", "comm_id", G.wkt_parse("wkt", 4326).alias("geom"))
    n = Z.zonal_stats(zone, tiles, grid, [1]).first()["count"]
    # about 1.37 km by 2.22 km in pixels of a hectare
    assert 290 < n < 320


def test_name_search_and_wildcards_have_no_nested_loop(spark):
    repos = spark.createDataFrame([(3, "alpha-beta"), (1, "beta"), (2, None), (4, "gamma")], "git_id long, name string")
    req = spark.createDataFrame([("beta",), ("a",), ("zzz",), ("beta",), ("alpha-beta-x",)], "request string")
    df = RP.search_repositories(req, repos)
    got = {r.request: r.git_id for r in df.collect()}
    assert got == {"beta": 1, "a": 1, "zzz": None, "alpha-beta-x": None} and "NestedLoop" not in plan_text(df)
    regions = spark.createDataFrame([(5, "AB1"), (6, "AB2"), (7, "AC1")], "gid long, nuts_id string")
    like = D.region_key_like_join(spark.createDataFrame([("%1",), ("ab_",), ("_c%",), ("q%",)], "k string"), "k", regions, vintage=None)
    assert {r.k: r.fk_nuts_gid for r in like.collect()} == {"%1": 5, "ab_": 5, "_c%": 7} and "NestedLoop" not in plan_text(like)


def test_points_meet_only_polygons_of_their_cell(spark):
    edges = [(z, x, 0.0, x, 4.0) for z, (a, b) in enumerate([(0.0, 4.0), (100.0, 104.0)]) for x in (a, b)]
    edges += [(z, a, y, b, y) for z, (a, b) in enumerate([(0.0, 4.0), (100.0, 104.0)]) for y in (0.0, 4.0)]
    e = spark.createDataFrame(edges, "zone long, x1 double, y1 double, x2 double, y2 double")
    p = spark.createDataFrame([(1, 1.0, 1.0), (2, 101.0, 3.5), (3, 50.0, 1.0), (4, 5.0, 1.0)], "pid long, x double, y double")
    assert sorted(tuple(r) for r in points_in_polygons(p, e, 3.0).collect()) == [(1, 0), (2, 1)]


def test_replace_reads_what_it_replaces_and_append_checks(spark, tmp_path):
    path = str(tmp_path / "t")
    SK.table_replace(spark.range(5).toDF("ID"), path)
    SK.table_replace(spark.read.parquet(path).filter("id > 2"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [3, 4]
    with pytest.raises(ValueError):
        SK.table_append(spark, spark.range(3).toDF("other"), path)


def _bytes(spark, shp, shx, dbf, cpg=None):
    return spark.createDataFrame([("s", bytearray(shp), bytearray(shx) if shx else None, bytearray(dbf) if dbf else None, cpg)], "source string, shp binary, shx binary, dbf binary, cpg string")


SQUARE = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0), (0.0, 0.0)]


@pytest.mark.parametrize("indexed", [True, False])
def test_shapefile_count_mismatch_is_an_error(spark, indexed):
    from regiostat.plans.shapefile_fixture import encode
    from regiostat.sources.vector import decode_shapefiles
    shp, shx, _ = encode([(i, "n", SQUARE) for i in range(3)], 5, "latin-1")
    dbf = encode([(1, "n", SQUARE)], 5, "latin-1")[2]
    with pytest.raises(Exception, match="3 shapes but 1"):
        decode_shapefiles(_bytes(spark, shp, shx if indexed else None, dbf)).collect()


@pytest.mark.parametrize("kind", [5, 15])
@pytest.mark.parametrize("records", [1, 4, 1000])
def test_shapefile_in_pieces(spark, kind, records):
    from regiostat.plans.shapefile_fixture import encode
    from regiostat.sources.vector import decode_shapefiles
    features = [(i, f"Bé{i}", None if i % 16 == 5 else [(x + i, y) for x, y in SQUARE]) for i in range(23)]
    shp, shx, dbf = encode(features, kind, "cp1252")
    want = {i: (f"Bé{i}", None if i % 16 == 5 else float(i)) for i in range(23) if i % 10 != 9}
    for index, cpg in ((shx, "1252"), (None, "ANSI 1252"), (shx, None)):
        rows = decode_shapefiles(_bytes(spark, shp, index, dbf, cpg), records=records).collect()
        assert {r.feature: (r.properties["name"], r.geom.parts[0][0][0].x if r.geom.parts else None) for r in rows} == want
        assert all((r.geom.type is None) == (r.geom.parts is None) for r in rows)
    assert len(decode_shapefiles(_bytes(spark, shp, shx, None), records=records).collect()) == 23
    empty = encode([], kind, "latin-1")
    assert decode_shapefiles(_bytes(spark, *empty)).collect() == []


def test_shape_types_with_z_and_m_and_unknown_ones():
    import struct
    from regiostat.sources.vector import decode_shape
    for kind in (1, 11, 21):
        assert decode_shape(struct.pack("<i4d", kind, 1, 2, 3, 4))[1][0][0].tolist() == [[1.0, 2.0]]
    for kind in (8, 18, 28):
        name, parts = decode_shape(struct.pack("<i4di4d", kind, 0, 0, 1, 1, 2, 1, 2, 3, 4) + b"\0" * 48)
        assert name == "MULTIPOINT" and parts[0][0].tolist() == [[1.0, 2.0], [3.0, 4.0]]
    assert decode_shape(struct.pack("<i", 0)) == decode_shape(struct.pack("<i9d", 31, *[0.0] * 9)) == (None, None)


def test_a_batch_that_is_replayed_changes_nothing(spark, tmp_path):
    import datetime as dt
    from regiostat.streaming.incremental import RunState, read_sink
    state = RunState(str(tmp_path / "state"), "2024-05-01 00:00:00", lambda df: df.withColumn("granularity", F.lit("day")), lambda df: df.select("name", F.lit(7).cast("bigint").alias("git_id")))
    assert read_sink(spark, str(tmp_path / "none")).count() == 0 and state.time_dim(spark).count() == 0 and state.registry(spark).count() == 0
    rows = lambda *days: spark.createDataFrame([(n, dt.datetime(2020, 1, d)) for n, d in days], "name string, timestamp timestamp_ntz")
    first = sorted(r.fk_time_id for r in state.extend(rows(("a", 1), ("a", 2)), 0).collect())
    again = sorted(r.fk_time_id for r in state.extend(rows(("a", 1), ("a", 2)), 0).collect())
    assert first == again == [1, 2] and state.time_dim(spark).count() == 2
    for _ in range(2):  # a later batch, twice
        assert sorted(r.fk_time_id for r in state.extend(rows(("b", 2), ("b", 3)), 1).collect()) == [2, 3]
    assert sorted(r.id for r in state.time_dim(spark).collect()) == [1, 2, 3]
    assert sorted((r.id, r.name) for r in state.registry(spark).collect()) == [(1, "a"), (2, "b")]
