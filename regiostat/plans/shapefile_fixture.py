"""Shapefile bytes of the scaled zones: one file per 16 of them.

Fixed values: files alternate between plain polygons and polygons with Z;
zones with ``gid % 16 = 5`` have an empty shape, those with ``gid % 10 = 9`` are
marked as deleted in the attribute table; every third file says ``UTF-8`` in a
``.cpg`` file, the others are Latin-1 without one.  Names hold a letter beyond
ASCII, so the encoding shows.
"""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PER_FILE, EMPTY, DELETED = 16, 5, 9
FIELDS = (("gid", "N", 12), ("name", "C", 16))
OUT = "source string, shp binary, shx binary, dbf binary, cpg string"


def _polygon(kind: int, ring: list[tuple[float, float]]) -> bytes:
    ring = ring if sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) <= 0 else ring[::-1]  # outer rings run clockwise
    xs, ys = [p[0] for p in ring], [p[1] for p in ring]
    body = struct.pack("<i4d3i", kind, min(xs), min(ys), max(xs), max(ys), 1, len(ring), 0) + b"".join(struct.pack("<2d", *p) for p in ring)
    return body if kind == 5 else body + struct.pack(f"<{2 + len(ring)}d", *[0.0] * (2 + len(ring)))


def encode(features: list[tuple[int, str, list | None]], kind: int, encoding: str) -> tuple[bytes, bytes, bytes]:
    """(id, name, ring or None) -> the bytes of .shp, .shx and .dbf."""
    records, index, at = b"", b"", 100
    for number, (_, _, ring) in enumerate(features, 1):
        body = struct.pack("<i", 0) if ring is None else _polygon(kind, ring)
        records += struct.pack(">2i", number, len(body) // 2) + body
        index += struct.pack(">2i", at // 2, len(body) // 2)
        at += 8 + len(body)

    def head(size: int) -> bytes:
        return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, size // 2) + struct.pack("<2i8d", 1000, kind, *[0.0] * 8)

    width = 1 + sum(n for *_, n in FIELDS)
    dbf = struct.pack("<4BIHH20x", 3, 124, 1, 1, len(features), 32 + 32 * len(FIELDS) + 1, width)
    for name, letter, n in FIELDS:
        dbf += name.encode().ljust(11, b"\0") + letter.encode() + b"\0" * 4 + bytes([n]) + b"\0" * 15
    dbf += b"\r"
    for gid, name, _ in features:
        dbf += (b"*" if gid % 10 == DELETED else b" ") + str(gid).encode().rjust(12) + name.encode(encoding).ljust(16)
    return head(100 + len(records)) + records, head(100 + len(index)) + index, dbf + b"\x1a"


def shapefile_bytes(zones: DataFrame) -> DataFrame:
    """``zones(gid, geom)`` -> ``source, shp, shx, dbf, cpg``."""
    def write(group: pd.DataFrame) -> pd.DataFrame:
        number = int(group["file"].iloc[0])
        kind, text = (5, 15)[number % 2], ("utf-8" if number % 3 == 0 else "latin-1")
        features = [(int(g), f"Bé{g}", None if g % 16 == EMPTY else [(p["x"], p["y"]) for p in ring]) for g, ring in sorted(zip(group["gid"], group["ring"]), key=lambda x: x[0])]
        return pd.DataFrame([(f"file{number}", *encode(features, kind, text), "UTF-8" if text == "utf-8" else None)], columns=["source", "shp", "shx", "dbf", "cpg"])

    rows = zones.select("gid", F.col("geom.parts")[0][0].alias("ring"), (F.col("gid") / PER_FILE).cast("bigint").alias("file"))
    return rows.groupBy("file").applyInPandas(write, OUT)
