"""Geometry as nested arrays, built and read with Catalyst expressions.

A geometry column is ``struct<srid:int, type:string,
parts:array<array<array<struct<x:double,y:double>>>>>`` (part -> ring ->
vertex); points and lines use one ring.  Parsing and formatting are string
and higher-order functions, so they run inside whole-stage codegen, no
Python per row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from regiostat.config import DEFAULT_SRID
from regiostat.functions.common import let


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _vertices(text: Column) -> Column:
    """``'1 2, 3 4'`` -> ``[{x:1,y:2},{x:3,y:4}]`` (parentheses removed)."""
    clean = F.trim(F.regexp_replace(text, r"[()]", ""))
    return F.transform(
        F.split(clean, r"\s*,\s*"),
        lambda v: F.struct(F.get(F.split(F.trim(v), r"\s+"), F.lit(0)).try_cast("double").alias("x"),
                           F.get(F.split(F.trim(v), r"\s+"), F.lit(1)).try_cast("double").alias("y")))


def _rings(text: Column) -> Column:
    return F.transform(F.split(text, r"\)\s*,\s*\("), _vertices)


def wkt_type(wkt) -> Column:
    return F.upper(F.regexp_extract(_col(wkt), r"^\s*([A-Za-z]+)", 1))


def wkt_parse(wkt, srid=DEFAULT_SRID) -> Column:
    """G1: WKT text -> geometry struct (``ST_GeomFromText(wkt, srid)``).

    Handles POINT, LINESTRING, POLYGON and their MULTI forms in two
    dimensions; anything else (EMPTY, Z and M forms, broken text) gives NULL
    parts.
    """
    w = _col(wkt)
    srid_col = F.lit(srid).cast("int") if not isinstance(srid, Column) else srid

    def head(s: Column) -> Column:
        body = F.regexp_extract(s, r"^\s*[A-Za-z]+\s*(\(.*\))\s*$", 1)
        return F.struct(wkt_type(s).alias("t"), F.regexp_replace(F.trim(body), r"^\(+|\)+$", "").alias("inner"))

    def build(h: Column) -> Column:
        typ, inner = h["t"], h["inner"]
        single_ring = F.array(F.array(_vertices(inner)))
        parts = (F.when(typ.isin("POINT", "LINESTRING", "MULTIPOINT"), single_ring)
                  .when(typ == "POLYGON", F.array(_rings(inner)))
                  .when(typ == "MULTILINESTRING",
                        F.transform(F.split(inner, r"\)\s*,\s*\("), lambda r: F.array(_vertices(r))))
                  .when(typ == "MULTIPOLYGON",
                        F.transform(F.split(inner, r"\)\s*\)\s*,\s*\(\s*\("), _rings)))
        return F.struct(typ.alias("type"), parts.alias("parts"))

    def checked(g: Column) -> Column:
        # a vertex that is no pair of numbers makes the whole text no geometry
        bad = F.exists(F.flatten(F.flatten(g["parts"])), lambda v: v["x"].isNull() | v["y"].isNull())
        return F.struct(srid_col.alias("srid"), g["type"].alias("type"), F.when(~bad, g["parts"]).alias("parts"))

    return let(let(let(w, head), build), checked)


def ewkt_parse(ewkt) -> Column:
    """``SRID=n;WKT`` -> geometry struct; without the prefix SRID is NULL."""
    e = _col(ewkt)
    srid = F.when(e.rlike(r"^\s*SRID=\d+;"), F.regexp_extract(e, r"^\s*SRID=(\d+);", 1).cast("int"))
    return wkt_parse(F.regexp_replace(e, r"^\s*SRID=\d+;", ""), srid)


def fmt_number(c: Column) -> Column:
    """Shortest text of a double, integral values without ``.0``."""
    return F.regexp_replace(c.cast("string"), r"\.0$", "")


def _fmt_vertex(p: Column) -> Column:
    return F.concat_ws(" ", fmt_number(p["x"]), fmt_number(p["y"]))


def _fmt_ring(r: Column) -> Column:
    return F.concat(F.lit("("), F.array_join(F.transform(r, _fmt_vertex), ","), F.lit(")"))


def _fmt_part(p: Column) -> Column:
    return F.concat(F.lit("("), F.array_join(F.transform(p, _fmt_ring), ","), F.lit(")"))


def wkt_format(geom) -> Column:
    """Geometry struct -> WKT text (``ExportToWkt``)."""
    g = _col(geom)
    t, parts = g["type"], g["parts"]
    first_ring = parts[0][0]
    body = (F.when(t.isin("POINT", "LINESTRING", "MULTIPOINT"), _fmt_ring(first_ring))
             .when(t.isin("POLYGON"), _fmt_part(parts[0]))
             .when(t == "MULTILINESTRING",
                   F.concat(F.lit("("), F.array_join(F.transform(parts, lambda p: _fmt_ring(p[0])), ","), F.lit(")")))
             .when(t == "MULTIPOLYGON",
                   F.concat(F.lit("("), F.array_join(F.transform(parts, _fmt_part), ","), F.lit(")"))))
    return F.concat(t, F.lit(" "), body)


def force_multi(geom) -> Column:
    """POLYGON -> MULTIPOLYGON (the part list already nests one level)."""
    g = _col(geom)
    t = F.when(g["type"] == "POLYGON", F.lit("MULTIPOLYGON")).otherwise(g["type"])
    return F.struct(g["srid"].alias("srid"), t.alias("type"), g["parts"].alias("parts"))


def set_srid(geom, srid: int) -> Column:
    """Stamp an SRID on a geometry."""
    g = _col(geom)
    return F.struct(F.lit(srid).cast("int").alias("srid"), g["type"].alias("type"), g["parts"].alias("parts"))


def num_vertices(geom) -> Column:
    return F.size(F.flatten(F.flatten(_col(geom)["parts"])))


def bbox(geom) -> Column:
    """``struct(xmin, ymin, xmax, ymax)`` of a geometry, row-local."""
    pts = F.flatten(F.flatten(_col(geom)["parts"]))
    xs, ys = F.transform(pts, lambda p: p["x"]), F.transform(pts, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
                    F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


# -- G5: ETRS89 / LAEA Europe (EPSG:3035) ---------------------------------------
# GRS80 ellipsoid and the EPSG:3035 projection parameters.
GRS80_A = 6378137.0
GRS80_INV_F = 298.257222101
LAEA_LAT0 = 52.0
LAEA_LON0 = 10.0
LAEA_FALSE_EASTING = 4321000.0
LAEA_FALSE_NORTHING = 3210000.0


def _laea_constants():
    f = 1.0 / GRS80_INV_F
    e2 = 2 * f - f * f
    e = math.sqrt(e2)

    def q(phi):
        s = math.sin(phi)
        return (1 - e2) * (s / (1 - e2 * s * s) - (1 / (2 * e)) * math.log((1 - e * s) / (1 + e * s)))

    phi0 = math.radians(LAEA_LAT0)
    qp, q0 = q(math.pi / 2), q(phi0)
    beta0 = math.asin(q0 / qp)
    rq = GRS80_A * math.sqrt(qp / 2)
    d = GRS80_A * (math.cos(phi0) / math.sqrt(1 - e2 * math.sin(phi0) ** 2)) / (rq * math.cos(beta0))
    return e2, e, qp, beta0, rq, d


def laea_project(lon, lat) -> tuple[Column, Column]:
    """Geographic degrees (ETRS89/WGS84) -> EPSG:3035 metres.

    Closed-form ellipsoidal Lambert azimuthal equal-area (Snyder 1987,
    equations 3-12, 24-2 ... 24-21), as column expressions.
    """
    e2, e, qp, beta0, rq, d = _laea_constants()
    phi, lam = F.radians(_col(lat)), F.radians(_col(lon))
    s = F.sin(phi)
    q = F.lit(1 - e2) * (s / (F.lit(1.0) - F.lit(e2) * s * s)
                         - F.lit(1 / (2 * e)) * F.log((F.lit(1.0) - F.lit(e) * s) / (F.lit(1.0) + F.lit(e) * s)))
    beta = F.asin(q / F.lit(qp))
    dlam = lam - F.lit(math.radians(LAEA_LON0))
    b = F.lit(rq) * F.sqrt(F.lit(2.0) / (F.lit(1.0) + F.lit(math.sin(beta0)) * F.sin(beta)
                                        + F.lit(math.cos(beta0)) * F.cos(beta) * F.cos(dlam)))
    east = F.lit(LAEA_FALSE_EASTING) + b * F.lit(d) * F.cos(beta) * F.sin(dlam)
    north = F.lit(LAEA_FALSE_NORTHING) + (b / F.lit(d)) * (
        F.lit(math.cos(beta0)) * F.sin(beta) - F.lit(math.sin(beta0)) * F.cos(beta) * F.cos(dlam))
    return east, north


def laea_constants() -> dict[str, float]:
    """Derived constants (for writing the same formula in another dialect)."""
    e2, e, qp, beta0, rq, d = _laea_constants()
    return {"e2": e2, "e": e, "qp": qp, "beta0": beta0, "rq": rq, "d": d,
            "lon0": math.radians(LAEA_LON0)}


def transform_to_laea(geom) -> Column:
    """G5 on geometries: ETRS89 (4258) / WGS84 (4326) lon-lat -> EPSG:3035 for
    every vertex; already 3035 is returned unchanged; other SRIDs give NULL
    parts (no general projection library is available)."""
    g = _col(geom)

    def proj(v: Column) -> Column:
        e, n = laea_project(v["x"], v["y"])
        return F.struct(e.alias("x"), n.alias("y"))

    projected = F.transform(g["parts"], lambda p: F.transform(p, lambda r: F.transform(r, proj)))
    parts = F.when(g["srid"] == 3035, g["parts"]).when(g["srid"].isin(4258, 4326), projected)
    srid = F.when(g["srid"].isin(3035, 4258, 4326), F.lit(3035))
    return F.struct(srid.alias("srid"), g["type"].alias("type"), parts.alias("parts"))
