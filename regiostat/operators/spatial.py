"""Point-in-polygon by equi-join.

The plane is cut into square cells of side ``bucket``.  Per polygon and row of
cells, the cells that an edge passes are its *border*; the runs between them are
wholly inside or wholly outside.  Inside runs are cut into blocks of 1, 2, 4, ...
cells (aligned), so a polygon makes cells in proportion to its border, however
large it is.  A point looks up its own cell and the blocks above it; in a block
it is inside without a test, in a border cell it meets the edges of the row
that lie on its cell or to the right (even-odd rule).  No polygon-by-point
product is formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat.session import materialize

#: Levels of blocks: runs of up to 2^40 cells.
LEVELS = 40
EDGE = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def _crosses(e: Column, x: Column, y: Column) -> Column:
    straddles = (e["y1"] > y) != (e["y2"] > y)
    return straddles & (x < e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"]))


def _inside(ring: Column, x: Column, y: Column) -> Column:
    return F.size(F.filter(ring, lambda e: _crosses(e, x, y))) % 2 == 1


def _blocks(first: Column, last: Column) -> Column:
    """``[first, last]`` as aligned blocks ``(k, at)`` of ``2^k`` cells."""
    none = F.expr("CAST(array() AS array<struct<k:int,at:bigint>>)")

    def step(s, k):
        odd, even = (s["a"] <= s["b"]) & (F.pmod(s["a"], F.lit(2)) == 1), (s["a"] <= s["b"]) & (F.pmod(s["b"], F.lit(2)) == 0)
        a = F.when(odd, s["a"] + 1).otherwise(s["a"])
        right = even & (a <= s["b"])
        b = F.when(right, s["b"] - 1).otherwise(s["b"])
        block = lambda c, at: F.when(c, F.array(F.struct(k.cast("int").alias("k"), at.alias("at")))).otherwise(none)
        return F.when(s["a"] > s["b"], s).otherwise(F.struct(F.shiftright(a, 1).alias("a"), F.shiftright(b, 1).alias("b"), F.concat(s["out"], block(odd, s["a"]), block(right, s["b"])).alias("out")))

    start = F.struct(first.cast("bigint").alias("a"), last.cast("bigint").alias("b"), none.alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS)), start, step, lambda s: s["out"])


def cell_cover(edges: DataFrame, bucket: float, zone_id: str = "zone") -> DataFrame:
    """``zone, cy, k, at, ring``: inner blocks (``ring`` null) and border cells
    (``k`` 0) with the edges a point in them has to be tested against."""
    def cell(c: Column) -> Column:
        return F.floor(c / bucket).cast("bigint")

    e = edges.select(zone_id, F.struct("x1", "y1", "x2", "y2").alias("e"), F.least("y1", "y2").alias("low"), F.greatest("y1", "y2").alias("high"))
    rows = e.select(zone_id, "e", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))).alias("cy"))
    rows = rows.groupBy(zone_id, "cy").agg(F.collect_list("e").alias("ring"))  # the edges of one row of cells
    bottom, slack = F.col("cy") * F.lit(bucket), F.lit(bucket * 1e-9)

    def passed(x: Column) -> Column:
        """Cells of the part of an edge that lies in the row."""
        def at(y: Column) -> Column:
            y = F.least(F.greatest(y, F.least(x["y1"], x["y2"])), F.greatest(x["y1"], x["y2"]))
            return x["x1"] + (y - x["y1"]) * (x["x2"] - x["x1"]) / (x["y2"] - x["y1"])
        level = x["y1"] == x["y2"]
        a, b = F.when(level, x["x1"]).otherwise(at(bottom)), F.when(level, x["x2"]).otherwise(at(bottom + F.lit(bucket)))
        return F.sequence(cell(F.least(a, b) - slack), cell(F.greatest(a, b) + slack))

    border = F.array_sort(F.array_distinct(F.flatten(F.transform("ring", passed))))
    rows = materialize(rows.select(zone_id, "cy", "ring", border.alias("border")), "cell-rows")
    gaps = F.filter(F.transform(F.sequence(F.lit(1), F.size("border")), lambda i: F.struct((F.get("border", i - 1) + 1).alias("a"), (F.get("border", i) - 1).alias("b"))),
                    lambda g: g["b"].isNotNull() & (g["a"] <= g["b"]))
    middle = bottom + F.lit(bucket / 2)
    inner = F.filter(gaps, lambda g: _inside(F.col("ring"), (g["a"] + 0.5) * F.lit(bucket), middle))
    blocks = rows.select(zone_id, "cy", F.explode(inner).alias("g")).select(zone_id, "cy", F.explode(_blocks(F.col("g.a"), F.col("g.b"))).alias("x"))
    right = lambda c: F.filter("ring", lambda e: F.greatest(e["x1"], e["x2"]) >= c * F.lit(bucket) - slack)
    cells = rows.select(zone_id, "cy", F.explode(F.transform("border", lambda c: F.struct(F.lit(0).alias("k"), c.alias("at"), right(c).alias("ring")))).alias("x"))
    return blocks.select(zone_id, "cy", "x.k", "x.at", F.lit(None).cast(EDGE).alias("ring")).unionByName(cells.select(zone_id, "cy", "x.k", "x.at", "x.ring"))


def points_in_polygons(points: DataFrame, edges: DataFrame, bucket: float,
                       point_id: str = "pid", zone_id: str = "zone") -> DataFrame:
    """``points(pid, x, y)``, ``edges(zone, x1, y1, x2, y2)`` -> ``(pid, zone)``
    for every polygon that contains the point (even-odd rule); ``bucket`` is
    the side of a cell."""
    cover = materialize(cell_cover(edges, bucket, zone_id), "cells")
    levels = sorted(r[0] for r in cover.select("k").distinct().collect()) or [0]  # LEVELS at most
    column = F.floor(F.col("x") / bucket).cast("bigint")
    p = points.select(point_id, F.col("x").alias("px"), F.col("y").alias("py"), F.floor(F.col("y") / bucket).cast("bigint").alias("cy"),
                      F.inline(F.array(*[F.struct(F.lit(k).alias("k"), F.shiftright(column, k).alias("at")) for k in levels])))
    met = p.join(cover, ["cy", "k", "at"])
    return met.filter(F.col("ring").isNull() | _inside(F.col("ring"), F.col("px"), F.col("py"))).select(point_id, zone_id)
