"""Views, sinks, vector files, geometry updates and the stream (stage 6)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from regiostat.functions import geometry as G
from regiostat.operators import dims as D
from regiostat.operators import hierarchy as H
from regiostat.operators import recompute as R
from regiostat.operators import tabular as TB
from regiostat.operators import views as VW
from regiostat.operators import zonal as Z
from regiostat.operators.spatial import points_in_polygons
from regiostat.plans.fixture_sql import cte, with_ctes
from regiostat.plans.fixtures import Fixtures, tabular_fields
from regiostat.plans.q_hierarchy import all_levels_sql, nuts3_sql, upper_sql
from regiostat.plans.q_tabular import INGEST_COLS, loaded_tabular
from regiostat.plans.registry import register
from regiostat.session import materialize, staging_path
from regiostat.sources import sinks as SK
from regiostat.sources.csv import write_csv_dataset
from regiostat.sources.vector import read_geojson
from regiostat.streaming.incremental import incremental_ingest, read_sink

cte("ingest_ided", ["ingest_fact"], "SELECT row_number() OVER (ORDER BY "
    + ", ".join(f"{c} NULLS FIRST" for c in INGEST_COLS) + ") AS id, * FROM ingest_fact")
cte("layer_view", ["ingest_ided", "ingest_tdim", "nuts"], """
SELECT f.*, t._ts AS timestamp, n.gid, n.nuts_id, n.stat_levl_, n.year
FROM ingest_ided f LEFT JOIN ingest_tdim t ON f.fk_time_id = t.id LEFT JOIN nuts n ON f.fk_nuts_gid = n.gid""")


def _ingest(spark, sf):
    fact, time_dim = loaded_tabular(spark, sf)
    return Fixtures(spark, sf), fact, time_dim


def layer_view(spark, sf):
    fx, fact, time_dim = _ingest(spark, sf)
    return VW.layer_view(fact, time_dim, fx.nuts())


LAYER_SQL = with_ctes(["layer_view"], "SELECT * EXCLUDE (id) FROM layer_view")


@register("layer_view_join", LAYER_SQL)
def q_layer_view_join(spark, sf):
    return layer_view(spark, sf).drop("id")


@register("publish_view", LAYER_SQL)
def q_publish_view(spark, sf):
    """The three tables are stored, the view in the catalog reads them."""
    fx, fact, time_dim = _ingest(spark, sf)
    paths = [SK.table_replace(df, staging_path(spark, name)) for name, df in (("view_fact", fact), ("view_time", time_dim), ("view_region", fx.nuts()))]
    sql = VW.layer_view_sql(paths[0], fact.columns, paths[1], paths[2], fx.nuts().columns)
    return SK.publish_view(spark, "ingest_layer_view", sql).drop("id")


@register("drop_colliding_columns", with_ctes(["lau_stats", "lau"], """
SELECT s.count, s.sum, s.mean, s.stddev, s.min, s.max, s.comm_id, s.fk_time_id, s.fk_lau_gid, l.fk_nuts_gid
FROM lau_stats s LEFT JOIN lau l ON l.comm_id = s.comm_id"""))
def q_drop_colliding_columns(spark, sf):
    fx = Fixtures(spark, sf)
    fact = H.attach_parent(fx.lau_stats(), fx.lau())
    return fact.select(*VW.drop_colliding_columns(fact, fx.nuts()))


# The four theme projections of the fixture layer view.
THEMES = {
    "ingest_value": ["key", "value_eur_m2", "value_eur_m2_unit", "nuts_id"],
    "ingest_value_alt": ["key", "value-eur-m2_1", "value-eur-m2_1_unit"],
    "ingest_count": ["count", "flag", "timestamp"],
    "ingest_region": ["gid", "stat_levl_", "year"],
}


def _content_sql(cols: list[str]) -> str:
    return "concat_ws('|', " + ", ".join(f"""COALESCE(CAST("{c.replace('-', '_')}" AS VARCHAR), 'NULL')""" for c in cols) + ")"


@register("theme_projections", with_ctes(["layer_view"], " UNION ALL ".join(
    f"SELECT '{name}' AS view, {_content_sql(cols)} AS content FROM layer_view" for name, cols in THEMES.items())))
def q_theme_projections(spark, sf):
    """Every row of every projection, as text; the view is read once."""
    views = VW.theme_projections(materialize(layer_view(spark, sf), "layer_view"), THEMES)
    parts = [v.select(F.lit(n).alias("view"), F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in v.columns]).alias("content"))
             for n, v in views.items()]
    return reduce(lambda a, b: a.unionAll(b), parts)


LAU_COLS = "count, sum, mean, stddev, min, max, comm_id, fk_time_id, fk_lau_gid"


@register("table_replace", with_ctes(["lau_stats"], f"SELECT {LAU_COLS} FROM lau_stats"))
def q_table_replace(spark, sf):
    fx = Fixtures(spark, sf)
    path = staging_path(spark, "lau_stats_table")
    even = F.col("fk_lau_gid") % 2 == 0
    SK.table_replace(fx.lau_stats().filter(even), path)                      # an older load
    half = spark.read.parquet(path)
    SK.table_replace(half.unionByName(fx.lau_stats().filter(~even)), path)   # reads what it replaces
    return spark.read.parquet(path)


@register("table_append", with_ctes(["nuts", "lau", "lau_stats"], all_levels_sql()))
def q_table_append(spark, sf):
    fx = Fixtures(spark, sf)
    l3 = materialize(H.nuts3_rollup(H.attach_parent(fx.lau_stats(), fx.lau()), fx.nuts()))
    path = staging_path(spark, "nuts_stats_table")
    SK.table_append(spark, l3.select(*H.NUTS_STAT_COLUMNS), path)
    SK.table_append(spark, H.nuts_upper_rollup(l3, fx.nuts()).select(*H.NUTS_STAT_COLUMNS), path)
    return spark.read.parquet(path)


@register("append_select", with_ctes(["nuts", "lau", "lau_stats"], f"""
SELECT * FROM ({nuts3_sql()}) UNION ALL SELECT min, max, sum, count, mean, nuts_id, stat_levl_,
  CAST(NULL AS BIGINT) AS fk_time_id, fk_nuts_gid FROM ({upper_sql(nuts3_sql())})"""))
def q_append_select(spark, sf):
    """``INSERT INTO t (cols) SELECT ...``: the appended query result lacks a
    column, which the append adds as NULL (P18)."""
    fx = Fixtures(spark, sf)
    l3 = materialize(H.nuts3_rollup(H.attach_parent(fx.lau_stats(), fx.lau()), fx.nuts()))
    path = staging_path(spark, "nuts_stats_table")
    SK.table_append(spark, l3.select(*H.NUTS_STAT_COLUMNS), path)
    l3.createOrReplaceTempView("nuts3_stats_src")
    spark.read.parquet(path).createOrReplaceTempView("nuts_stats_tbl")
    upper = H.nuts_upper_rollup(spark.table("nuts_stats_tbl"), fx.nuts()).drop("fk_time_id")
    SK.table_append(spark, upper, path, allow_missing=True)
    return spark.read.parquet(path)


@register("geometry_update", with_ctes(["zvert"], """
SELECT 'N' || CAST(gid AS VARCHAR) AS comm_id, count(*) AS n_vertices,
  min(x) + CASE WHEN gid % 3 = 0 THEN 1.0 ELSE 0.0 END AS xmin FROM zvert GROUP BY gid"""))
def q_geometry_update(spark, sf):
    """New geometries (shifted by 1 for every third zone, forced to
    MULTIPOLYGON) replace the old ones by ``comm_id`` in one job."""
    fx = Fixtures(spark, sf)
    zones = fx.zones()
    shifted = G.force_multi(F.struct(
        F.col("geom.srid").alias("srid"), F.col("geom.type").alias("type"),
        F.transform("geom.parts", lambda p: F.transform(p, lambda r: F.transform(
            r, lambda v: F.struct((v["x"] + 1.0).alias("x"), v["y"].alias("y"))))).alias("parts")))
    new = zones.filter(F.col("gid") % 3 == 0).select("comm_id", shifted.alias("geom"))
    upd = R.geometry_update(zones, new)
    return upd.select("comm_id", G.num_vertices("geom").cast("bigint").alias("n_vertices"),
                      F.col("geom").getField("parts"), G.bbox("geom")["xmin"].alias("xmin")).drop("geom.parts")


# bands: region r covers 0 <= x < 1100, 40 r <= y < 40 r + 40
cte("bands", [], """
SELECT CAST(r_regionkey AS BIGINT) AS zone, 0.0 AS x1, 40.0 * r_regionkey AS y1, 0.0 AS x2, 40.0 * r_regionkey + 40 AS y2 FROM region
UNION ALL SELECT r_regionkey, 1100.0, 40.0 * r_regionkey, 1100.0, 40.0 * r_regionkey + 40 FROM region""")
cte("zcenter", ["zvert"], """
SELECT gid AS pid, (min(x) + max(x)) / 2 AS x, (min(y) + max(y)) / 2 AS y FROM zvert GROUP BY gid""")


@register("zone_cover_join", with_ctes(["bands", "zcenter"], """
SELECT p.pid, e.zone FROM zcenter p JOIN bands e
  ON (e.y1 > p.y) <> (e.y2 > p.y) AND p.x < e.x1 + (p.y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
GROUP BY p.pid, e.zone HAVING count(*) % 2 = 1"""))
def q_zone_cover_join(spark, sf):
    """Municipality -> covering region by point-in-polygon of a
    representative point (bbox centre) against the region polygons."""
    fx = Fixtures(spark, sf)
    b = G.bbox("geom")
    pts = fx.zones().select(F.col("gid").alias("pid"), ((b["xmin"] + b["xmax"]) / 2).alias("x"),
                            ((b["ymin"] + b["ymax"]) / 2).alias("y"))
    r = fx.t("region").select(F.col("r_regionkey").cast("bigint").alias("zone"),
                              (F.col("r_regionkey") * 40.0).alias("y0"))
    band_wkt = F.concat(F.lit("POLYGON((0 "), F.col("y0").cast("string"), F.lit(", 1100 "), F.col("y0").cast("string"),
                        F.lit(", 1100 "), (F.col("y0") + 40).cast("string"), F.lit(", 0 "),
                        (F.col("y0") + 40).cast("string"), F.lit(", 0 "), F.col("y0").cast("string"), F.lit("))"))
    polys = r.select("zone", G.wkt_parse(band_wkt).alias("geom"))
    edges = Z.zone_edges(polys, ids=("zone",))
    return points_in_polygons(pts, edges, bucket=10.0)


def feature_text():
    """A zone (gid, comm_id, geom) as the text of a GeoJSON feature."""
    coords = F.to_json(F.transform("geom.parts", lambda p: F.transform(p, lambda r: F.transform(
        r, lambda v: F.array(v["x"], v["y"]))))[0])
    feat = F.concat(F.lit('{"type": "Feature", "properties": {"gid": "'), F.col("gid").cast("string"),
                    F.lit('", "comm_id": "'), F.col("comm_id"), F.lit('"}, "geometry": {"type": "Polygon", '
                                                                      '"coordinates": '), coords, F.lit("}}"))
    return feat


@register("vector_features_scan", with_ctes(["sedge"], """
SELECT gid, 'B' || CAST(gid AS VARCHAR) AS comm_id, 'POLYGON' AS type, CAST(4 AS BIGINT) AS n_vertices,
  min(x1) AS xmin, max(y1) AS ymax FROM sedge GROUP BY gid"""))
def q_vector_features_scan(spark, sf):
    """Zones (as many as the data has blocks) written as GeoJSON features,
    one per line, and read back."""
    z = Fixtures(spark, sf).scaled_zones()
    path = staging_path(spark, "zones_geojson")
    z.select(feature_text().alias("value")).write.mode("overwrite").text(path)     # one Feature per line
    f = read_geojson(spark, path, sequence=True)
    b = G.bbox("geom")
    return f.select(F.col("properties")["gid"].cast("bigint").alias("gid"), F.col("properties")["comm_id"].alias("comm_id"),
                    F.col("geom.type").alias("type"), G.num_vertices("geom").cast("bigint").alias("n_vertices"),
                    b["xmin"].alias("xmin"), b["ymax"].alias("ymax"))


@register("shapefile_scan", with_ctes(["sedge"], """
SELECT gid, 'Bé' || CAST(gid AS VARCHAR) AS name, CASE WHEN gid % 16 <> 5 THEN 'MULTIPOLYGON' END AS type,
  CASE WHEN gid % 16 <> 5 THEN 4 END AS n_vertices, CASE WHEN gid % 16 <> 5 THEN xmin END AS xmin, CASE WHEN gid % 16 <> 5 THEN ymax END AS ymax
FROM (SELECT gid, min(x1) AS xmin, max(y1) AS ymax FROM sedge GROUP BY gid) WHERE gid % 10 <> 9"""))
def q_shapefile_scan(spark, sf):
    """Zones as shapefile bytes (with index, attributes, code page; plain and
    Z polygons, empty shapes, deleted rows), decoded in pieces of five."""
    from regiostat.plans.shapefile_fixture import shapefile_bytes
    from regiostat.sources.vector import decode_shapefiles
    f = decode_shapefiles(materialize(shapefile_bytes(Fixtures(spark, sf).scaled_zones()), "shapefiles"), records=5)
    b = G.bbox("geom")
    return f.select(F.col("properties")["gid"].cast("bigint").alias("gid"), F.col("properties")["name"].alias("name"), F.col("geom.type").alias("type"),
                    F.when(F.col("geom.parts").isNotNull(), G.num_vertices("geom").cast("int")).alias("n_vertices"), b["xmin"].alias("xmin"), b["ymax"].alias("ymax"))


@register("incremental_state", with_ctes(["accepted_tabular", "raw_tabular", "nuts"], """
, keyed AS (SELECT a."key", a.value_eur_m2_1, a.datetime FROM accepted_tabular a JOIN (SELECT nuts_id, min(gid) AS gid FROM nuts WHERE year = DATE '2013-01-01'
  GROUP BY nuts_id) n ON upper(a."key") = n.nuts_id)
SELECT CAST(step AS INTEGER) AS step, count("key") AS n_fact, count(DISTINCT datetime) AS n_time, count(DISTINCT upper(substr("key", 1, 3))) AS n_registry,
  count("key") - count(datetime) AS n_timeless
FROM (VALUES (0), (1), (2), (3)) s(step) LEFT JOIN keyed ON step > 1 OR (step = 1 AND value_eur_m2_1 < 125) GROUP BY step""").replace("\n\n,", ",").replace("\n,", ","))
def q_incremental_state(spark, sf):
    """T1 + U1 + U2: four catch-up runs, without files, over the first part of
    the raw dataset, over the rest, and without anything new: rows, times and
    registered sources after each."""
    from regiostat.streaming.incremental import RunState
    fx = Fixtures(spark, sf)
    raw = materialize(fx.raw_tabular(), "raw")
    landing, sink, rejects, ckpt, folder = (staging_path(spark, n) for n in ("landing", "sink", "rejects", "stream_ckpt", "run_state"))
    plan, nuts = TB.schema_plan(tabular_fields()), materialize(fx.nuts(), "nuts")
    raw.limit(0).write.mode("overwrite").option("header", True).option("sep", ";").csv(f"{landing}/none")
    code = F.upper(F.substring("key", 1, 3))
    state = RunState(folder, "2024-01-01 00:00:00", lambda df: df.withColumns({"timestamp": F.col("datetime"), "granularity": F.lit("day")}),
                     lambda df: df.select(code.alias("name"), F.crc32(code.cast("binary")).alias("git_id")))

    def transform(df):
        acc, rej = TB.reject_rows(TB.typed_projection(df, plan), plan)
        return D.region_key_join(acc.select("key", "value_eur_m2", "value_eur_m2_1", "count", "datetime"), "key", nuts), rej

    first = F.col("Value-EUR-m2").cast("decimal(20,2)") < 125
    rows = []
    for step, part in enumerate((None, raw.filter(first), raw.filter(~first), None)):
        if part is not None:
            part.write.mode("append").option("header", True).option("sep", ";").csv(f"{landing}/part{step}")
        incremental_ingest(spark, f"{landing}/*", raw.columns, sink, ckpt, transform, delimiter=";", reject_dir=rejects, state=state)
        seen = read_sink(spark, sink)
        timeless = seen.filter("fk_time_id IS NULL").count() if seen.columns else 0
        rows.append(spark.range(1).select(F.lit(step).alias("step"), F.lit(seen.count()).cast("bigint").alias("n_fact"), F.lit(state.time_dim(spark).count()).cast("bigint").alias("n_time"),
                                          F.lit(state.registry(spark).count()).cast("bigint").alias("n_registry"), F.lit(timeless).cast("bigint").alias("n_timeless")))
    return reduce(lambda a, b: a.unionByName(b), rows)


@register("incremental_ingest", with_ctes(["typed_tabular", "accepted_tabular", "nuts"], """
, keyed AS (SELECT a."key", a.value_eur_m2, a."count", n.gid AS fk_nuts_gid
FROM accepted_tabular a JOIN (SELECT nuts_id, min(gid) AS gid FROM nuts WHERE year = DATE '2013-01-01'
  GROUP BY nuts_id) n ON upper(a."key") = n.nuts_id)
SELECT *, (SELECT count(*) FROM keyed) AS n_run1, (SELECT count(*) FROM keyed) AS n_run2,
  (SELECT count(*) FROM typed_tabular) - (SELECT count(*) FROM accepted_tabular) AS n_rejected FROM keyed""").replace("\n\n,", ",").replace("\n,", ","))
def q_incremental_ingest(spark, sf):
    """The raw dataset lands as CSV files; a catch-up stream types,
    filters and keys them and stores the rejects; a second run finds no new
    file and adds nothing.  The counts after each run are read from the sink."""
    fx = Fixtures(spark, sf)
    raw = fx.raw_tabular()
    landing, sink, rejects, ckpt = (staging_path(spark, n) for n in ("landing", "sink", "rejects", "stream_ckpt"))
    raw.write.mode("overwrite").option("header", True).option("sep", ";").csv(landing)
    plan = TB.schema_plan(tabular_fields())
    nuts = fx.nuts()

    def transform(df):
        acc, rej = TB.reject_rows(TB.typed_projection(df, plan), plan)
        return D.region_key_join(acc.select("key", "value_eur_m2", "count"), "key", nuts), rej

    runs = []
    for _ in range(2):
        incremental_ingest(spark, landing, raw.columns, sink, ckpt, transform, delimiter=";", reject_dir=rejects)
        runs.append(read_sink(spark, sink).count())
    return read_sink(spark, sink).select("key", "value_eur_m2", "count", "fk_nuts_gid", F.lit(runs[0]).cast("bigint").alias("n_run1"),
                                         F.lit(runs[1]).cast("bigint").alias("n_run2"), F.lit(read_sink(spark, rejects).count()).cast("bigint").alias("n_rejected"))


@register("vector_package", with_ctes(["sedge"], """
SELECT gid, 'B' || CAST(gid AS VARCHAR) AS comm_id, 'MULTIPOLYGON' AS type, CAST(4 AS BIGINT) AS n_vertices, min(x1) AS xmin,
  DATE '2015-01-01' AS date, TIMESTAMP '2015-01-01 00:00:00' AS timestamp, CAST(1 AS BIGINT) AS fk_time_id FROM sedge GROUP BY gid"""))
def q_vector_package(spark, sf):
    """A vector resource from file to table: features, types, multi geometry,
    time of the manifest."""
    from regiostat.plans.pipelines import integrate_vector
    folder = staging_path(spark, "vector_package")
    zones = Fixtures(spark, sf).scaled_zones()
    zones.select(feature_text().alias("value")).write.mode("overwrite").text(f"{folder}/data/zones")
    resource = {"name": "zones", "path": "data/zones", "format": "geojsonl", "temporal": {"start": "2015-01-01"}, "temporal_resolution": "year",
                "vector": {"epsg": "3035", "schema": [{"name": "gid", "unit": "", "type": "integer"}, {"name": "comm_id", "unit": "", "type": "string"}]}}
    out = integrate_vector(spark, folder, resource, None, f"{folder}/out")
    f = spark.read.parquet(out.tables["features"])
    return f.select("gid", "comm_id", F.col("geom.type").alias("type"), G.num_vertices("geom").cast("bigint").alias("n_vertices"),
                    G.bbox("geom")["xmin"].alias("xmin"), "date", "timestamp", "fk_time_id")


@register("raster_package", with_ctes(["nuts", "slau", "szonal"], all_levels_sql("szonal", "slau")))
def q_raster_package(spark, sf):
    """A raster resource from pixels to NUTS tables: time id, tiles stored by
    time, pyramid, statistics of municipalities and of all levels."""
    from regiostat.plans.pipelines import integrate_raster_package
    fx = Fixtures(spark, sf)
    pixels = fx.scaled_pixels().withColumn("fk_time_id", F.lit(None).cast("bigint"))
    out = integrate_raster_package([pixels], {"name": "raster", "temporal": {"start": "2015-01-01"}}, fx.scaled_grid(), fx.scaled_zones(),
                                   materialize(fx.scaled_lau(), "scaled_lau"), fx.nuts(), None, staging_path(spark, "raster_package"), pyramid_levels=2)
    return spark.read.parquet(out.tables["nuts_stats"])
