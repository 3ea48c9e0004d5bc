"""Vector features (S4): GeoJSON and ESRI shapefiles, many files per job.

GeoJSON is read by Spark's JSON source (``explode(features)``); geometry
coordinates become the nested-array geometry struct.  Shapefiles are read as
``binaryFile`` rows and cut into pieces by their index (``.shx``); a ``mapInArrow``
step decodes the pieces (the format is a binary record layout with no Spark
reader), so one large file and thousands of small ones spread over the cluster.
"""

from __future__ import annotations

import codecs
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiostat.config import DEFAULT_SRID

PT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
PARTS = T.ArrayType(T.ArrayType(T.ArrayType(PT)))
GEOM = T.StructType([T.StructField("srid", T.IntegerType()), T.StructField("type", T.StringType()),
                     T.StructField("parts", PARTS)])

FEATURE = T.StructType([
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", T.StructType([T.StructField("type", T.StringType()),
                                           T.StructField("coordinates", T.StringType())]))])
GEOJSON_SCHEMA = T.StructType([T.StructField("type", T.StringType()),
                               T.StructField("features", T.ArrayType(FEATURE))])


def read_geojson(spark: SparkSession, path: str, srid: int = DEFAULT_SRID, sequence: bool = False) -> DataFrame:
    """GeoJSON -> one row per feature: ``properties`` (map of text) and
    ``geom``.  ``sequence=False`` reads FeatureCollection documents (one per
    file); ``sequence=True`` reads one Feature per line, which splits large
    files across tasks.  Coordinates are parsed per geometry type from their
    JSON text, so one explicit schema covers points to multipolygons."""
    if sequence:
        f = spark.read.schema(FEATURE).json(path).select(
            F.input_file_name().alias("source"), F.struct("properties", "geometry").alias("f"))
    else:
        raw = spark.read.schema(GEOJSON_SCHEMA).option("multiLine", True).json(path)
        f = raw.select(F.input_file_name().alias("source"), F.explode("features").alias("f"))
    t = F.col("f.geometry.type")
    c = F.col("f.geometry.coordinates")
    d4 = F.from_json(c, "array<array<array<array<double>>>>")
    d3 = F.from_json(c, "array<array<array<double>>>")
    d2 = F.from_json(c, "array<array<double>>")
    d1 = F.from_json(c, "array<double>")
    pt = lambda v: F.struct(v[0].alias("x"), v[1].alias("y"))
    ring = lambda r: F.transform(r, pt)
    parts = (F.when(t == "MultiPolygon", F.transform(d4, lambda p: F.transform(p, ring)))
              .when(t == "Polygon", F.array(F.transform(d3, ring)))
              .when(t == "MultiLineString", F.transform(d3, lambda r: F.array(ring(r))))
              .when(t.isin("LineString", "MultiPoint"), F.array(F.array(ring(d2))))
              .when(t == "Point", F.array(F.array(F.array(pt(d1))))))
    geom = F.struct(F.lit(srid).alias("srid"), F.upper(t).alias("type"), parts.alias("parts"))
    return f.select("source", F.col("f.properties").alias("properties"), geom.alias("geom"))


# -- shapefile ----------------------------------------------------------------------------
SHP_OUT = T.StructType([T.StructField("source", T.StringType()), T.StructField("feature", T.IntegerType()),
                        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
                        T.StructField("geom", GEOM)])
#: Shape types by their last digit: 2D (1..8), with Z (11..18) and with M (21..28)
#: begin with the same plane coordinates.  Others (and empty shapes) have no geometry.
_SHAPE_TYPES = {1: "POINT", 3: "MULTILINESTRING", 5: "MULTIPOLYGON", 8: "MULTIPOINT"}
_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
_ARROW = pa.schema([("source", pa.string()), ("feature", pa.int32()), ("properties", pa.map_(pa.string(), pa.string())),
                    ("geom", pa.struct([("srid", pa.int32()), ("type", pa.string()), ("parts", pa.list_(pa.list_(pa.list_(_POINT))))]))])


def _ring_area(r: np.ndarray) -> float:
    return float((r[:-1, 0] * r[1:, 1] - r[1:, 0] * r[:-1, 1]).sum()) / 2.0


def decode_dbf(head: bytes, records: bytes, encoding: str) -> list[dict[str, str] | None]:
    """Attribute rows (None: marked as deleted) from the header and whole records."""
    width = int.from_bytes(head[10:12], "little")
    fields, off, at = [], 32, 1
    while off < len(head) and head[off] != 0x0D:
        fields.append((head[off:off + 11].split(b"\0")[0].decode("latin-1"), at, at + head[off + 16]))
        at += head[off + 16]
        off += 32
    rows = []
    for pos in range(0, len(records) - width + 1, width):
        rec = records[pos:pos + width]
        rows.append(None if rec[:1] == b"*" else {name: rec[a:b].decode(encoding, "replace").strip() for name, a, b in fields})
    return rows


def decode_shape(rec: bytes) -> tuple[str | None, list[list[np.ndarray]] | None]:
    """One record's content -> (type, parts); polygon rings are grouped into
    parts by orientation (a clockwise outer ring starts a part, holes follow)."""
    kind = int.from_bytes(rec[:4], "little")
    base = kind % 10 if kind < 30 else 0
    name = _SHAPE_TYPES.get(base)
    if name is None:
        return None, None
    if base == 1:
        return name, [[np.frombuffer(rec, "<f8", 2, 4).reshape(1, 2)]]
    if base == 8:
        return name, [[np.frombuffer(rec, "<f8", 2 * int.from_bytes(rec[36:40], "little"), 40).reshape(-1, 2)]]
    n_parts, n_points = np.frombuffer(rec, "<i4", 2, 36).tolist()
    starts = [*np.frombuffer(rec, "<i4", n_parts, 44).tolist(), n_points]
    points = np.frombuffer(rec, "<f8", 2 * n_points, 44 + 4 * n_parts).reshape(-1, 2)
    rings = [points[a:b] for a, b in zip(starts[:-1], starts[1:])]
    if base == 3:
        return name, [[r] for r in rings]
    parts: list[list[np.ndarray]] = []
    for r in rings:
        if _ring_area(r) <= 0 or not parts:   # clockwise = outer ring
            parts.append([r])
        else:
            parts[-1].append(r)
    return name, parts


def _encoding(cpg: str | None) -> str:
    """Python's name for what a ``.cpg`` file says (``UTF-8``, ``1252``, ``ANSI 1252``,
    ``88591``); Latin-1 without one."""
    digits = re.sub("[^0-9]", "", cpg or "")
    for name in ((cpg or "").strip(), "utf-8" if digits == "65001" else "", f"cp{digits}", f"iso8859-{digits[4:]}" if digits.startswith("8859") else ""):
        try:
            return codecs.lookup(name).name
        except LookupError:
            continue
    return "latin-1"


def _nested(features: list[list[list[np.ndarray]] | None]) -> pa.Array:
    """Parts of many features as one Arrow array, built from flat coordinates."""
    rings = [r for f in features if f for part in f for r in part]
    flat = np.concatenate(rings) if rings else np.zeros((0, 2))
    lengths = lambda sizes: pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    points = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], fields=list(_POINT))
    out = pa.ListArray.from_arrays(lengths([len(r) for r in rings]), points)
    out = pa.ListArray.from_arrays(lengths([len(part) for f in features if f for part in f]), out)
    sizes = np.concatenate([[0], np.cumsum([len(f or []) for f in features])])
    return pa.ListArray.from_arrays(pa.array(sizes.astype(np.int32), mask=np.array([*[f is None for f in features], False])), out)


def _decode_pieces(srid: int):
    def run(batches):
        for rows in batches:
            for source, first, index, shp, head, dbf, cpg in zip(*(rows[k].to_pylist() for k in ("source", "first", "index", "shp", "head", "dbf", "cpg"))):
                if index is None:             # no .shx: the records follow each other
                    spans, pos = [], 100
                    while pos + 8 <= len(shp):
                        size = 2 * int.from_bytes(shp[pos + 4:pos + 8], "big")
                        spans.append((pos, size))
                        pos += 8 + size
                else:                         # offsets and sizes in words of 16 bits
                    entries = np.frombuffer(index, ">i4").reshape(-1, 2).astype(np.int64) * 2
                    spans = [(a, n) for a, n in zip((entries[:, 0] - entries[:, 0].min()).tolist(), entries[:, 1].tolist())]
                shapes = [decode_shape(shp[a + 8:a + 8 + n]) for a, n in spans]
                attributes = decode_dbf(head, dbf, _encoding(cpg)) if head is not None else [{}] * len(shapes)
                if len(shapes) != len(attributes):
                    raise ValueError(f"{source}: {len(shapes)} shapes but {len(attributes)} attribute rows")
                kept = [i for i, a in enumerate(attributes) if a is not None]
                geom = pa.StructArray.from_arrays([pa.array([srid] * len(kept), pa.int32()), pa.array([shapes[i][0] for i in kept], pa.string()), _nested([shapes[i][1] for i in kept])], fields=list(_ARROW.field("geom").type))
                yield pa.RecordBatch.from_arrays([pa.array([source] * len(kept), pa.string()), pa.array([first + i for i in kept], pa.int32()), pa.array([list(attributes[i].items()) for i in kept], _ARROW.field("properties").type), geom], schema=_ARROW)
    return run


def _number(b: Column, at: Column | int, size: int, little: bool) -> Column:
    """Unsigned whole number in ``size`` bytes of a binary from byte ``at`` (0-based)."""
    at = F.lit(at) if isinstance(at, int) else at
    order = range(size - 1, -1, -1) if little else range(size)
    return F.conv(F.hex(F.concat(*[F.substring(b, (at + i + 1).cast("int"), F.lit(1)) for i in order])), 16, 10).cast("bigint")


def decode_shapefiles(files: DataFrame, srid: int = DEFAULT_SRID, records: int = 1_000) -> DataFrame:
    """``files(source, shp, shx, dbf, cpg)`` (bytes; all but ``shp`` may be null)
    -> one row per feature that is not marked as deleted.

    The ``.shx`` index tells where records lie, so that a file is cut into
    pieces of ``records`` features, index, shapes and attributes of each, and the
    pieces are decoded by many tasks.  A file without index is one piece.  Shapes
    without plane coordinates (empty ones, patches) have no parts."""
    f = files.select("source", "shp", "shx", "dbf", "cpg", ((F.octet_length("shx") - 100) / 8).cast("int").alias("n"),
                     _number(F.col("dbf"), 4, 4, True).alias("rows"), _number(F.col("dbf"), 8, 2, True).alias("hl"), _number(F.col("dbf"), 10, 2, True).alias("rl"))
    odd = F.col("n").isNotNull() & F.col("rows").isNotNull() & (F.col("n") != F.col("rows"))
    message = F.concat("source", F.lit(": "), F.col("n").cast("string"), F.lit(" shapes but "), F.col("rows").cast("string"), F.lit(" attribute rows"))
    f = f.filter(F.when(odd, F.raise_error(message).cast("boolean")).otherwise(F.coalesce(F.col("n") > 0, F.lit(True))))
    pieces = f.select("*", F.explode(F.when(F.col("n").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("n") - 1, F.lit(records)))).alias("first"))
    many = F.least(F.lit(records), F.col("n") - F.col("first"))
    entry = lambda k, at: _number(F.col("shx"), F.lit(100) + (F.col("first") + k) * 8 + at, 4, False) * 2
    extent = F.transform(F.sequence(F.lit(0), many - 1), lambda k: F.struct(entry(k, 0).alias("a"), (entry(k, 0) + 8 + entry(k, 4)).alias("b")))
    pieces = pieces.withColumn("extent", F.when(F.col("n").isNotNull(), extent))
    begin, end = F.array_min(F.transform("extent", lambda x: x["a"])), F.array_max(F.transform("extent", lambda x: x["b"]))
    part = lambda b, a, size: F.substring(F.col(b), (a + 1).cast("int"), size.cast("int"))
    whole = F.col("n").isNull()
    cut = pieces.select("source", "first", "cpg",
                        F.when(~whole, part("shx", F.lit(100) + F.col("first") * 8, many * 8)).alias("index"),
                        F.when(whole, F.col("shp")).otherwise(part("shp", begin, end - begin)).alias("shp"),
                        part("dbf", F.lit(0), F.col("hl")).alias("head"),
                        F.when(whole, part("dbf", F.col("hl"), F.col("rl") * F.col("rows"))).otherwise(part("dbf", F.col("hl") + F.col("rl") * F.col("first"), F.col("rl") * many)).alias("dbf"))
    return cut.repartition("source", "first").mapInArrow(_decode_pieces(srid), SHP_OUT)


def read_shapefiles(spark: SparkSession, folder: str, srid: int = DEFAULT_SRID) -> DataFrame:
    """Shapefiles (``.shp`` with ``.shx``, ``.dbf``, ``.cpg`` if there) below ``folder`` ->
    one row per feature."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    kind = F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1))
    files = files.select(F.regexp_replace("path", r"\.[A-Za-z]+$", "").alias("source"), kind.alias("kind"), "content")
    out = files.filter("kind = 'shp'").select("source", F.col("content").alias("shp"))
    for k in ("shx", "dbf", "cpg"):
        own = files.filter(F.col("kind") == k).select("source", (F.col("content").cast("string") if k == "cpg" else F.col("content")).alias(k))
        out = out.join(own, "source", "left")
    return decode_shapefiles(out, srid)
