import json
import os
import struct
from decimal import Decimal

from pyspark.sql import functions as F

from regiostat.operators import recompute as R
from regiostat.operators import validate as V
from regiostat.sources import manifest as M
from regiostat.sources.vector import read_geojson, read_shapefiles
from regiostat.streaming.incremental import incremental_ingest, read_sink


def manifests(spark, docs):
    rows = [(k, v if isinstance(v, str) else json.dumps(v)) for k, v in docs.items()]
    return M.manifest_scan(spark.createDataFrame(rows, "package string, json string"))


def test_rules_report_and_gate(spark):
    docs = {
        "ok": {"profile": V.RASTER, "resources": [{"name": "r", "path": "data/r.tif", "unit": "u", "format": "tif",
                                                    "raster": {"epsg": "3035"}}]},
        "nogeo": {"profile": V.TABULAR, "resources": [{"name": "t", "path": "p", "schema": {"fields": [
            {"name": "a", "unit": "", "type": "string"}]}, "encoding": "utf-8", "format": "csv", "dialect": {}}]},
        "bad": {"profile": V.VECTOR, "resources": [{"name": "x" * 55 + ".shp", "path": "data/v.shp", "unit": "u",
                                                    "vector": {"geometry_type": "blob", "schema": [{"name": "a"}]}}]},
        "weird": {"profile": "other", "resources": [{"name": "w"}]},
        "broken": '{"profile": "raster-data-resource", "resou',
    }
    m = manifests(spark, docs)
    listing = spark.createDataFrame([("ok/data/r.tif",), ("ok/datapackage.json",)], "path string")
    v = V.all_violations(m, M.manifest_resources(m), listing)
    msgs = {}
    for r in v.collect():
        msgs.setdefault(r.package, []).append(r.message)
    assert "ok" not in msgs
    assert msgs["nogeo"] == [V.MSG_NO_GEOMETRY]
    assert set(msgs["bad"]) == {V.MSG_NAME_LONG, V.MSG_NAME_EXT, V.MSG_PATH, V.MSG_GEOM_TYPE, V.MSG_VECTOR_SCHEMA,
                                "resources/format", "vector/epsg"}
    assert msgs["weird"] == [V.MSG_PROFILE]
    gate = {r.package: r.decision for r in V.validation_gate(m, v).collect()}
    assert gate == {"ok": "load", "nogeo": "load_with_warning", "bad": "skip", "weird": "skip", "broken": "skip"}
    rep = {r.package: r.report for r in V.validation_report(v).collect()}
    assert rep["bad"].startswith("Errors: \n") and "\nMissing properties: \nresources/format\nvector/epsg" in rep["bad"]


def _shp_and_dbf(folder):
    polys = [[[(0, 0), (0, 4), (4, 4), (4, 0), (0, 0)]],                              # clockwise outer
             [[(10, 10), (10, 14), (14, 14), (14, 10), (10, 10)],
              [(11, 11), (13, 11), (13, 13), (11, 13), (11, 11)],                      # hole (ccw)
              [(20, 20), (20, 21), (21, 21), (21, 20), (20, 20)]]]                     # second part
    recs = b""
    for i, rings in enumerate(polys):
        pts = [p for r in rings for p in r]
        starts, s = [], 0
        for r in rings:
            starts.append(s)
            s += len(r)
        body = struct.pack("<i4d2i", 5, 0, 0, 0, 0, len(rings), len(pts))
        body += struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in pts)
        recs += struct.pack(">2i", i + 1, len(body) // 2) + body
    header = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(recs)) // 2) + struct.pack("<2i4d4d", 1000, 5,
                                                                                              0, 0, 21, 21, 0, 0, 0, 0)
    with open(os.path.join(folder, "zones.shp"), "wb") as f:
        f.write(header + recs)
    fields = [(b"comm_id", 8)]
    dbf = struct.pack("<4BIHH20x", 3, 124, 1, 1, len(polys), 32 + 32 * len(fields) + 1, 1 + 8)
    for name, ln in fields:
        dbf += name.ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([ln]) + b"\0" * 15
    dbf += b"\r" + b"".join(b" " + v.ljust(8) for v in (b"DK1", b"DK2")) + b"\x1a"
    with open(os.path.join(folder, "zones.dbf"), "wb") as f:
        f.write(dbf)


def test_shapefile_and_geojson(spark, tmp_path):
    _shp_and_dbf(str(tmp_path))
    rows = sorted(read_shapefiles(spark, str(tmp_path)).collect(), key=lambda r: r.feature)
    assert [r.properties["comm_id"] for r in rows] == ["DK1", "DK2"]
    assert [len(r.geom.parts) for r in rows] == [1, 2] and len(rows[1].geom.parts[0]) == 2
    gj = os.path.join(tmp_path, "f.geojson")
    with open(gj, "w") as f:
        json.dump({"type": "FeatureCollection", "features": [
            {"type": "Feature", "properties": {"id": "1"}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
            {"type": "Feature", "properties": {"id": "2"},
             "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]]]}}]}, f)
    g = {r.properties["id"]: r.geom for r in read_geojson(spark, gj).collect()}
    assert g["1"].type == "POINT" and g["1"].parts[0][0][0].x == 1.0
    assert g["2"].type == "MULTIPOLYGON" and len(g["2"].parts[0][0]) == 4


def test_stream_second_run_adds_nothing(spark, tmp_path):
    landing, sink, ckpt = (os.path.join(tmp_path, n) for n in ("in", "out", "ckpt"))
    os.makedirs(landing)
    with open(os.path.join(landing, "a.csv"), "w") as f:
        f.write("k,v\na,1\nb,2\n")
    tf = lambda df: df.withColumn("v", F.col("v").cast("int"))
    incremental_ingest(spark, landing, ["k", "v"], sink, ckpt, tf)
    incremental_ingest(spark, landing, ["k", "v"], sink, ckpt, tf)
    assert read_sink(spark, sink).count() == 2
    with open(os.path.join(landing, "b.csv"), "w") as f:
        f.write("k,v\nc,3\n")
    incremental_ingest(spark, landing, ["k", "v"], sink, ckpt, tf)
    assert read_sink(spark, sink).count() == 3


def test_update_from_null_wins_and_compat(spark):
    cols = "count long, sum decimal(20,2), mean decimal(20,2), stddev decimal(20,2), min decimal(20,2), " \
           "max decimal(20,2), comm_id string, fk_time_id long, fk_lau_gid long"
    old = spark.createDataFrame([(1, Decimal(5), Decimal(5), Decimal(0), Decimal(5), Decimal(5), "DK1", 1, 1),
                                 (2, Decimal(6), Decimal(3), Decimal(1), Decimal(2), Decimal(4), "SE1", 1, 2)], cols)
    new = spark.createDataFrame([(None, None, None, None, None, None, "DK1", 1, 1),
                                 (9, Decimal(9), Decimal(1), Decimal(0), Decimal(1), Decimal(1), "SE1", 1, 2)], cols)
    out = {r.comm_id: r for r in R.region_recompute_lau(old, new, "DK").collect()}
    assert out["DK1"]["count"] is None and out["DK1"]["sum"] is None      # recomputed NULL wins
    assert out["SE1"]["count"] == 2                                        # outside the prefix
    compat = {r.comm_id: r for r in R.region_recompute_lau(old, new, "DK", compat=True).collect()}
    assert compat["DK1"]["sum"] == Decimal(5)                               # original leaves sum stale
