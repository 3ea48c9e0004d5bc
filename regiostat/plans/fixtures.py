"""Inputs derived from the driver tables (FIXTURES.md part B), Spark side.

Every formula here has a twin in :mod:`regiostat.plans.fixture_sql`; the two
must stay identical so that the DuckDB oracle sees the same inputs.
All derivations are per-row projections, explodes of small literal ranges or
equi-joins, so they grow with the source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat.functions.decimals import double_to_stat, exact_mean, to_stat
from regiostat.session import read_table

# Fixed values of the derived fixtures.
VINTAGE = "2013-01-01"
OLD_VINTAGE = "2010-01-01"
EXCLUDE_MOD = 11          # customers with o_custkey % 11 = 0 get NULL statistics
RECOMPUTE_PREFIX = "C1"   # plays the part of a country prefix
TIMES = 3                 # several-times variant: fk_time_id = 1 + o_orderkey % 3


def cached(fn):
    """Reuse the (immutable) DataFrame that this object's method built for the
    same arguments: building a plan costs many JVM round trips, executing it is
    unaffected.  Every query makes an object of its own."""
    def wrapper(self, *args, **kwargs):
        key = (fn.__name__, args, tuple(sorted(kwargs.items())))
        memo = self._memo
        if key not in memo:
            memo[key] = fn(self, *args, **kwargs)
        return memo[key]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


class Fixtures:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._memo: dict = {}

    @cached
    def t(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # -- B.1 region hierarchy ---------------------------------------------------
    @cached
    def nuts(self) -> DataFrame:
        r = self.t("region").select(F.col("r_regionkey").alias("rk"),
                                    F.upper(F.substring("r_name", 1, 2)).alias("cc"))
        n = (self.t("nation").join(r, F.col("n_regionkey") == F.col("rk"))
             .select("n_nationkey", F.concat("cc", F.expr("chr(65 + n_nationkey)")).alias("n1")))
        y13, y10 = F.lit(VINTAGE).cast("date"), F.lit(OLD_VINTAGE).cast("date")

        def row(gid, nid, lvl, year):
            return [gid.cast("bigint").alias("gid"), nid.alias("nuts_id"),
                    F.lit(lvl).cast("int").alias("stat_levl_"), year.alias("year")]

        l0 = r.select(*row(F.col("rk") + 1, F.col("cc"), 0, y13))
        l0_old = r.select(*row(F.col("rk") + 900001, F.col("cc"), 0, y10))
        l1 = n.select(*row(F.col("n_nationkey") + 100, F.col("n1"), 1, y13))
        na = n.withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(2))))
        l2 = na.select(*row(F.col("n_nationkey") * 3 + F.col("a") + 1000,
                            F.concat("n1", F.col("a").cast("string")), 2, y13))
        nab = na.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(3))))
        l3 = nab.select(*row(F.col("n_nationkey") * 12 + F.col("a") * 4 + F.col("b") + 10000,
                             F.concat("n1", F.col("a").cast("string"), F.col("b").cast("string")), 3, y13))
        return l0.unionByName(l0_old).unionByName(l1).unionByName(l2).unionByName(l3)

    # -- B.2 municipalities -----------------------------------------------------
    @cached
    def lau(self) -> DataFrame:
        c = self.t("customer").select(
            F.col("c_custkey").cast("bigint").alias("gid"),
            F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("comm_id"),
            (F.col("c_nationkey") * 12 + (F.col("c_custkey") % 3) * 4 + F.col("c_custkey") % 4 + 10000)
            .cast("bigint").alias("fk_nuts_gid"))
        n3 = self.nuts().filter("stat_levl_ = 3 AND year = DATE'2013-01-01'").select(
            F.col("gid").alias("n_gid"), "nuts_id")
        return c.join(n3, c.fk_nuts_gid == n3.n_gid, "left").drop("n_gid")

    # -- B.3 municipality statistics --------------------------------------------
    def _price(self) -> DataFrame:
        return self.t("orders").select(
            "o_orderkey", "o_custkey", "o_orderpriority",
            F.col("o_totalprice").cast("decimal(20,2)").alias("v"))

    @staticmethod
    def _stats(grouped) -> DataFrame:
        return grouped.agg(
            F.count(F.lit(1)).alias("count"), to_stat(F.sum("v")).alias("sum"),
            double_to_stat(F.stddev_pop(F.col("v").cast("double"))).alias("stddev"),
            to_stat(F.min("v")).alias("min"), to_stat(F.max("v")).alias("max"))

    _STAT_COLS = ["count", "sum", "mean", "stddev", "min", "max"]

    @cached
    def lau_stats(self, times: int = 1, even_only: bool = False) -> DataFrame:
        """One row per municipality (and time), NULL statistics for the
        excluded ones, as the zonal step leaves zones without pixels."""
        o = self._price().filter(F.col("o_custkey") % EXCLUDE_MOD != 0)
        if even_only:
            o = o.filter(F.col("o_orderkey") % 2 == 0)
        o = o.withColumn("fk_time_id", (F.lit(1) + F.col("o_orderkey") % times).cast("bigint"))
        agg = (self._stats(o.groupBy("o_custkey", "fk_time_id"))
               .withColumn("mean", exact_mean("sum", "count")))
        grid = self.lau().select("gid", "comm_id").withColumn(
            "fk_time_id", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(times).cast("bigint"))))
        j = grid.join(agg, (grid.gid == agg.o_custkey) & (grid.fk_time_id == agg.fk_time_id), "left")
        return j.select(*self._STAT_COLS, "comm_id", grid.fk_time_id, F.col("gid").alias("fk_lau_gid"))

    @cached
    def dataset_stats(self, even_only: bool = False) -> DataFrame:
        """Statistics per (dataset, municipality): one dataset per order
        priority; the excluded customers keep NULL statistics."""
        o = self._price()
        if even_only:
            o = o.filter(F.col("o_orderkey") % 2 == 0)
        o = o.withColumn(
            "dataset", F.concat(F.lit("ds_"), F.regexp_replace(F.lower("o_orderpriority"), "[^a-z0-9]+", "_")))
        agg = (self._stats(o.groupBy("dataset", "o_custkey"))
               .withColumn("mean", exact_mean("sum", "count")))
        excluded = F.col("o_custkey") % EXCLUDE_MOD == 0
        stats = [F.when(~excluded, F.col(c)).alias(c) for c in self._STAT_COLS]
        return agg.select(
            "dataset", *stats, F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("comm_id"),
            F.lit(1).cast("bigint").alias("fk_time_id"), F.col("o_custkey").alias("fk_lau_gid"))


# -- B.6 / B.7 raster and zones -------------------------------------------------
# Nodata, zone shapes (offsets from the lower-left corner of each
# zone; rings are closed).  Raster and zones grow with the data: a pixel per
# order, a zone per 32 x 32 block that holds an order.
NODATA = -9999.0
SQUARE_OUTER = [(0, 0), (30, 0), (30, 30), (0, 30), (0, 0)]
SQUARE_HOLE = [(10, 10), (19, 10), (19, 19), (10, 19), (10, 10)]
TRIANGLE = [(0, 0), (30, 2), (11, 30), (0, 0)]
ZONE_AT = 1.25             # corner of a zone in its block
OUTSIDE_ZONE = 24          # every 25th zone (gid % 25) is moved off the raster, has no pixels
OUTSIDE_X = 100000.0


def _ring_text(x0, y0, ring):
    from regiostat.functions.geometry import fmt_number
    parts = []
    for i, (dx, dy) in enumerate(ring):
        if i:
            parts.append(F.lit(", "))
        parts += [fmt_number(x0 + F.lit(float(dx))), F.lit(" "), fmt_number(y0 + F.lit(float(dy)))]
    return F.concat(F.lit("("), *parts, F.lit(")"))


def _pixels(self, layer: int) -> DataFrame:
    k = F.col("o_orderkey")
    o = self.t("orders")
    if layer == 1:
        value = F.when(F.col("o_orderstatus") == "P", F.lit(NODATA)).otherwise(F.floor("o_totalprice"))
    else:
        o, value = o.filter(k % 3 != 0), F.col("o_custkey") % 50
    return o.select(F.lit(layer).cast("bigint").alias("fk_time_id"), (k % SCALED_WIDTH).alias("col"),
                    (k / SCALED_WIDTH).cast("bigint").alias("row"), value.cast("double").alias("value"))


def _pixels_all(self) -> DataFrame:
    """Pixel table ``(fk_time_id, col, row, value)``: time 1 = B.6 layer,
    time 2 = the second (overlapping) layer."""
    return self.pixels_layer(1).unionByName(self.pixels_layer(2))


def _tiles(self) -> DataFrame:
    from regiostat.operators.raster import tiles_from_pixels
    return tiles_from_pixels(self.pixels(), self.scaled_grid())


def _blocks(self) -> DataFrame:
    """Blocks of the raster that hold an order: ``bx, by, gid``."""
    per_row, p = SCALED_WIDTH // SCALED_BLOCK, self.scaled_pixels()
    b = p.select((F.col("col") / SCALED_BLOCK).cast("bigint").alias("bx"),
                 (F.col("row") / SCALED_BLOCK).cast("bigint").alias("by")).distinct()
    return b.select("bx", "by", (F.col("by") * per_row + F.col("bx")).alias("gid"))


def _zone_wkt(self) -> DataFrame:
    """B.7: one polygon per block as WKT text, with its parent NUTS 3."""
    g = F.col("gid")
    x0 = F.col("bx") * float(SCALED_BLOCK) + F.when(g % 25 == OUTSIDE_ZONE, OUTSIDE_X).otherwise(0.0) + ZONE_AT
    y0 = F.col("by") * float(SCALED_BLOCK) + ZONE_AT
    square = F.concat(F.lit("POLYGON("), _ring_text(x0, y0, SQUARE_OUTER), F.lit(","),
                      _ring_text(x0, y0, SQUARE_HOLE), F.lit(")"))
    tri = F.concat(F.lit("POLYGON("), _ring_text(x0, y0, TRIANGLE), F.lit(")"))
    return _blocks(self).select(g, F.concat(F.lit("N"), g.cast("string")).alias("comm_id"),
                                (g % 25 * 12 + 10000).cast("bigint").alias("fk_nuts_gid"),
                                F.when(g % 2 == 0, square).otherwise(tri).alias("wkt"))


def _zones(self) -> DataFrame:
    from regiostat.functions.geometry import wkt_parse
    return self.zone_wkt().select("gid", "comm_id", wkt_parse("wkt").alias("geom"))


def _zone_lau(self) -> DataFrame:
    n3 = self.nuts().filter("stat_levl_ = 3 AND year = DATE'2013-01-01'").select(
        F.col("gid").alias("n_gid"), "nuts_id")
    z = self.zone_wkt().select("gid", "comm_id", "fk_nuts_gid")
    return z.join(n3, z.fk_nuts_gid == n3.n_gid, "left").drop("n_gid")


def _lonlat(self) -> DataFrame:
    """B.8: lon/lat points from customer."""
    c = F.col("c_custkey")
    return self.t("customer").select(
        c.alias("gid"), ((c * 37 % 3500) / 100.0 - 5).alias("lon"), ((c * 53 % 3500) / 100.0 + 35).alias("lat"))


Fixtures.pixels_layer = cached(_pixels)
Fixtures.pixels = cached(_pixels_all)
Fixtures.tiles = cached(_tiles)
Fixtures.zone_wkt = cached(_zone_wkt)
Fixtures.zones = cached(_zones)
Fixtures.zone_lau = cached(_zone_lau)
Fixtures.lonlat = cached(_lonlat)


# -- B.4 / B.5 time text and raw tabular dataset ------------------------------------
# Bad texts and granularity spellings used by the fixture.
BAD_TIME_TEXT = ["", "abc", "31/02/2015"]
GRANULARITY_TEXT = ["Yearly", "MONTH", "day", "hourly", "decade"]
BOOL_TEXT = ["t", "f", "yes", "no"]


def _time_text(self) -> DataFrame:
    """B.4: per order a true timestamp, its text in one of the 17 formats
    (bad text for every 101st order) and a granularity spelling."""
    from regiostat.functions.timefuncs import STRPTIME_FORMATS
    k = F.col("o_orderkey")
    off = (k % 24) * 3600 + (k % 60) * 60 + k % 59
    o = self.t("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus",
                                F.timestamp_add("SECOND", off, F.col("o_orderdate")).alias("ts"))
    from regiostat.functions.timefuncs import spark_pattern
    pats = ", ".join(f"'{spark_pattern(f, padded=True)}'" for f in STRPTIME_FORMATS)
    # one date_format with a per-row pattern keeps the expression small
    txt = F.expr(f"date_format(ts, element_at(array({pats}), CAST(o_orderkey % 17 + 1 AS INT)))")
    bad = F.element_at(F.array(*[F.lit(b) for b in BAD_TIME_TEXT]), ((k / 101).cast("bigint") % 3 + 1).cast("int"))
    txt = F.when(k % 101 == 0, bad).otherwise(txt)
    gran = F.element_at(F.array(*[F.lit(g) for g in GRANULARITY_TEXT]), (k % 5 + 1).cast("int"))
    return o.select("*", txt.alias("ts_text"), gran.alias("gran_text"))


def _raw_tabular(self) -> DataFrame:
    """B.5: the raw CSV dataset (all text) derived from orders."""
    k = F.col("o_orderkey")
    tt = self.time_text()
    lau = self.lau().select(F.col("gid").alias("o_custkey"), "nuts_id")
    j = tt.join(lau, "o_custkey", "left")
    price = F.col("o_totalprice").cast("decimal(20,2)").cast("string")
    return j.select(
        F.when(k % 50 == 0, F.lit("ZZ999")).otherwise(F.lower("nuts_id")).alias("key"),
        F.when(k % 997 == 0, F.lit("n/a")).when(k % 13 == 0, F.lit("")).otherwise(price).alias("Value EUR/m2"),
        ((k % 1000) / F.lit(4.0)).cast("decimal(20,2)").cast("string").alias("Value-EUR-m2"),
        F.when(k % 89 == 0, F.lit("3.0")).otherwise((k % 1000).cast("string")).alias("count"),
        F.element_at(F.array(*[F.lit(b) for b in BOOL_TEXT]), (k % 4 + 1).cast("int")).alias("flag"),
        F.col("ts_text").alias("datetime"),
        F.col("o_orderstatus").alias("comment"))


def tabular_fields():
    """The manifest field list of the B.5 dataset."""
    from regiostat.operators.tabular import FieldSpec
    return [FieldSpec("key", "string", "region"), FieldSpec("Value EUR/m2", "number", "EUR"),
            FieldSpec("Value-EUR-m2", "number", "EUR"), FieldSpec("count", "integer", ""),
            FieldSpec("flag", "boolean", "bool"), FieldSpec("datetime", "datetime", ""),
            FieldSpec("comment", "text", "")]


TABULAR_START = "2013-01-01 00:00:00"
TABULAR_RESOLUTION = "Yearly"

Fixtures.time_text = cached(_time_text)
Fixtures.raw_tabular = cached(_raw_tabular)


# -- a raster and zone set that grow with the data ---------------------------------------
# One pixel per order on a grid 1024 pixels wide; one triangular
# zone per 32 x 32 block that holds an order (vertex offsets inside the block).
SCALED_WIDTH = 1024
SCALED_BLOCK = 32
SCALED_TRIANGLE = [(1.25, 1.25), (30.75, 3.25), (12.25, 29.75), (1.25, 1.25)]


def _dataset_name():
    return F.concat(F.lit("ds_"), F.regexp_replace(F.lower("o_orderpriority"), "[^a-z0-9]+", "_")).alias("dataset")


def _scaled_pixels(self, with_dataset: bool = False) -> DataFrame:
    k = F.col("o_orderkey")
    return self.t("orders").select(
        *([_dataset_name()] if with_dataset else []),
        F.lit(1).cast("bigint").alias("fk_time_id"), (k % SCALED_WIDTH).alias("col"),
        (k / SCALED_WIDTH).cast("bigint").alias("row"),
        F.when(F.col("o_orderstatus") == "P", F.lit(NODATA)).otherwise(F.col("o_totalprice")).alias("value"))


#: Zones whose geometry is sent again (every second), and of these the ones
#: that really change (every fourth); the prefix that is recomputed.
SCALED_CHANGED = [(2.25, 3.25), (28.75, 1.25), (24.25, 30.75), (5.75, 22.25), (2.25, 3.25)]
SCALED_SENT, SCALED_NEW = 2, 4
SCALED_PREFIX = "B1"


def _scaled_geoms(self) -> DataFrame:
    """New geometries of the scaled zones: ``comm_id, geom``."""
    old = self.scaled_zones().filter(F.col("gid") % SCALED_SENT == 0)
    new = _block_zones(self, SCALED_CHANGED).select("comm_id", F.col("geom").alias("new"))
    return old.join(new, "comm_id").select("comm_id", F.when(F.col("gid") % SCALED_NEW == 0, F.col("new")).otherwise(F.col("geom")).alias("geom"))


def _dataset_tiles(self) -> DataFrame:
    """The scaled raster as one dataset per order priority, on one grid."""
    from regiostat.operators.raster import tiles_from_pixels
    p = self.scaled_pixels(with_dataset=True)
    return tiles_from_pixels(p, self.scaled_grid(), keys=("dataset",))


def _scaled_zones(self) -> DataFrame:
    return _block_zones(self, SCALED_TRIANGLE)


def _block_zones(self, shape) -> DataFrame:
    from regiostat.functions.geometry import fmt_number, wkt_parse
    b = _blocks(self)
    x0, y0 = F.col("bx") * float(SCALED_BLOCK), F.col("by") * float(SCALED_BLOCK)
    pts = []
    for i, (dx, dy) in enumerate(shape):
        if i:
            pts.append(F.lit(", "))
        pts += [fmt_number(x0 + dx), F.lit(" "), fmt_number(y0 + dy)]
    wkt = F.concat(F.lit("POLYGON(("), *pts, F.lit("))"))
    gid = F.col("gid")
    return b.select("gid", F.concat(F.lit("B"), gid.cast("string")).alias("comm_id"),
                    wkt_parse(wkt).alias("geom"))


def _scaled_lau(self) -> DataFrame:
    """Parents of the scaled zones, spread over all level-3 regions."""
    n3 = self.nuts().filter("stat_levl_ = 3 AND year = DATE'2013-01-01'").select(F.col("gid").alias("fk_nuts_gid"), "nuts_id")
    g = F.col("gid")
    z = self.scaled_zones().select("gid", "comm_id", (F.lit(10000) + g % 25 * 12 + g % 3 * 4 + g % 4).cast("bigint").alias("fk_nuts_gid"))
    return z.join(n3, "fk_nuts_gid", "left").select("gid", "comm_id", "fk_nuts_gid", "nuts_id")


def _layered_tiles(self) -> DataFrame:
    """Tiles of the scaled raster in three times (by order key), and a second
    layer over every fifth pixel with a value higher by one."""
    from regiostat.operators.raster import tiles_from_pixels
    k = F.col("row") * SCALED_WIDTH + F.col("col")
    p = self.scaled_pixels().withColumn("fk_time_id", (1 + k % 3).cast("bigint"))
    over = p.filter(k % 5 == 0).withColumn("value", F.when(F.col("value") != NODATA, F.col("value") + 1).otherwise(F.col("value")))
    g = self.scaled_grid()
    return tiles_from_pixels(p, g, layer=1).unionByName(tiles_from_pixels(over, g, layer=2))


def _grid(self):
    """The grid of the scaled raster, as high as its last pixel."""
    from regiostat.operators.raster import Grid
    last = self.t("orders").agg(F.max("o_orderkey")).first()[0] or 0
    return Grid(width=SCALED_WIDTH, height=int(last) // SCALED_WIDTH + 1, tile_w=32, tile_h=32, nodata=NODATA)


Fixtures.scaled_grid = cached(_grid)
Fixtures.scaled_geoms = cached(_scaled_geoms)
Fixtures.dataset_tiles = cached(_dataset_tiles)
Fixtures.scaled_lau = cached(_scaled_lau)
Fixtures.layered_tiles = cached(_layered_tiles)
Fixtures.scaled_pixels = cached(_scaled_pixels)
Fixtures.scaled_zones = cached(_scaled_zones)
