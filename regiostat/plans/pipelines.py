"""End-to-end package integration, composed from the operators.

A run validates every package (one frame for all manifests), then integrates
the accepted resources.  Each dataset has its own schema, so datasets are
iterated on the driver (metadata only, fetched as the run goes on); every
dataset's rows are processed by one distributed plan and written once.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat.config import DEFAULT_RESOLUTION, DEFAULT_SRID, DEFAULT_START
from regiostat.functions import geometry as G
from regiostat.functions.text import sanitize_name_py
from regiostat.functions.timefuncs import normalize_granularity, parse_date_multi
from regiostat.operators import dims as D
from regiostat.operators import hierarchy as H
from regiostat.operators import raster as RA
from regiostat.operators import tabular as TB
from regiostat.operators import validate as V
from regiostat.operators import zonal as Z
from regiostat.operators.raster import Grid
from regiostat.session import materialize
from regiostat.sources import manifest as M
from regiostat.sources import sinks as SK
from regiostat.sources.csv import has_broken_lines, read_csv_dataset
from regiostat.sources.vector import read_geojson, read_shapefiles


@dataclass
class Validation:
    manifests: DataFrame
    resources: DataFrame
    violations: DataFrame
    gate: DataFrame
    report: DataFrame


_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def file_listing(spark: SparkSession, root: str) -> DataFrame:
    """Paths below ``root`` relative to it (``package/...``), files and the
    folders above them, from a distributed file listing (no bytes read)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
             .select(F.regexp_replace("path", _SCHEME, "").alias("path")))
    prefix = re.sub(_SCHEME, "", root).rstrip("/") + "/"
    parts = F.split(F.substring(F.col("path"), F.lit(len(prefix) + 1), F.length("path")), "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    return files.filter(F.col("path").startswith(prefix)).select(F.explode(above).alias("path")).distinct()


def validate_packages(spark: SparkSession, root: str) -> Validation:
    """V1-V16 for every ``<root>/<package>/datapackage.json``."""
    listing = file_listing(spark, root)
    packages = listing.select(F.split("path", "/")[0].alias("package")).distinct()
    m = materialize(M.read_manifest_files(spark, f"{root.rstrip('/')}/*/datapackage.json"), "manifests")
    res = M.manifest_resources(m)
    viol = (V.all_violations(m, res, listing).unionByName(V.corrupt_manifests(m))
            .unionByName(V.repo_layout_violations(packages, listing)))
    # a package without a manifest is judged too: it has no row among the manifests
    judged = m.select("package", "corrupt").unionByName(
        packages.join(m.select("package"), "package", "left_anti").withColumn("corrupt", F.lit(False)))
    return Validation(m, res, viol, V.validation_gate(judged, viol), V.validation_report(viol))


def _fields(resource: dict) -> list[TB.FieldSpec]:
    return [TB.FieldSpec(f.get("name"), f.get("type") or "", f.get("unit"))
            for f in ((resource.get("schema") or {}).get("fields") or [])]


@dataclass
class Package:
    """What one integrated resource left behind (table folders)."""
    tables: dict[str, str]
    time_dim: DataFrame
    issues: DataFrame | None = None


def integrate_tabular(spark: SparkSession, package_dir: str, resource: dict, nuts: DataFrame,
                      lau: DataFrame, time_dim: DataFrame | None, out_dir: str) -> TB.IngestResult:
    """S3 -> P2..P10 -> J1/J2 -> U1/J3 -> P4 -> W1 -> S7 for one CSV resource."""
    dialect = resource.get("dialect") or {}
    path = os.path.join(package_dir, resource["path"])
    encoding = resource.get("encoding")
    raw = read_csv_dataset(spark, path, dialect.get("delimiter"), dialect.get("doubleQuote"), encoding,
                           multi_line=has_broken_lines(spark, path, encoding))
    sr = resource.get("spatial_resolution")
    regions = nuts if (sr or "").lower().startswith("nuts") else lau
    temporal = resource.get("temporal") or {}
    res = TB.ingest_tabular(raw, _fields(resource), regions, sr, resource.get("spatial_key_field"), time_dim,
                            resource.get("temporal_resolution") or DEFAULT_RESOLUTION,
                            temporal.get("start") or DEFAULT_START, dataset=resource.get("name") or "dataset")
    SK.table_replace(res.fact, os.path.join(out_dir, "fact"))
    SK.table_replace(res.time_dim, os.path.join(out_dir, "time"))
    return res


def _start_time(spark: SparkSession, resource: dict, time_dim: DataFrame | None) -> tuple[str, str, DataFrame]:
    """Start date and resolution of a resource, and the time dimension with it."""
    start = (resource.get("temporal") or {}).get("start") or DEFAULT_START
    resolution = resource.get("temporal_resolution") or DEFAULT_RESOLUTION
    keys = spark.range(1).select(parse_date_multi(F.lit(start)).alias("timestamp"), normalize_granularity(F.lit(resolution)).alias("granularity"))
    return start, resolution, D.time_dim_upsert(time_dim, keys)


def integrate_vector(spark: SparkSession, package_dir: str, resource: dict, time_dim: DataFrame | None, out_dir: str) -> Package:
    """S4 -> P3 -> G4 -> P5 (U1/J3) -> S7 for one vector resource: features
    with typed attributes, multi geometries and the time of the manifest.
    Features without a readable geometry are left out and leave an issue."""
    vector = resource.get("vector") or {}
    path, srid = os.path.join(package_dir, resource["path"]), int(vector.get("epsg") or DEFAULT_SRID)
    feats = read_shapefiles(spark, path, srid) if resource.get("format") == "shp" else read_geojson(spark, path, srid, sequence=resource.get("format") == "geojsonl")
    fields = [TB.FieldSpec(f.get("name"), f.get("type") or "", f.get("unit")) for f in vector.get("schema") or []]
    plan = TB.schema_plan(fields)
    typed = feats.select(*[TB.typed_value(TB.empty_to_null(F.try_element_at("properties", F.lit(c.raw))), c.type).alias(c.column) for c in plan.columns],
                         G.force_multi("geom").alias("geom"))
    start, resolution, new_dim = _start_time(spark, resource, time_dim)
    new_dim = materialize(new_dim, "time")
    rows = materialize(TB.unit_columns(TB.metadata_columns(typed, start, resolution, new_dim), plan), "features")
    tables = {"features": SK.table_replace(rows.filter("geom.parts IS NOT NULL"), os.path.join(out_dir, "features")),
              "time": SK.table_replace(new_dim, os.path.join(out_dir, "time"))}
    lost = rows.filter("geom.parts IS NULL").agg(F.count(F.lit(1)).alias("n_messages")).filter("n_messages > 0")
    name = resource.get("name") or "dataset"
    issues = lost.select(F.lit(name).alias("dataset"), F.lit(f"Integration error {name}").alias("name"), F.lit("Features without a readable geometry were left out.").alias("description"),
                         F.lit(SK.ISSUE_TYPE).alias("issue_type"), F.lit(None).cast("array<string>").alias("tags"), "n_messages")
    return Package(tables, new_dim, issues)


def integrate_raster(tiles: DataFrame, zones: DataFrame, lau: DataFrame, nuts: DataFrame, grid: Grid,
                     time_ids: list[int], out_dir: str, overlaps: bool = False) -> tuple[DataFrame, DataFrame]:
    """Tiles -> municipality statistics table -> NUTS 0-3 table."""
    spark = tiles.sparkSession
    lau_path = SK.table_replace(Z.zonal_stats(zones, tiles, grid, time_ids, overlaps=overlaps), os.path.join(out_dir, "lau_stats"))
    lau_stats = spark.read.parquet(lau_path)
    nuts_path = SK.table_replace(H.rollup_all(lau_stats, lau, nuts), os.path.join(out_dir, "nuts_stats"))
    return lau_stats, spark.read.parquet(nuts_path)


def integrate_raster_package(layers: list[DataFrame], resource: dict, grid: Grid, zones: DataFrame, lau: DataFrame, nuts: DataFrame,
                             time_dim: DataFrame | None, out_dir: str, pyramid_levels: int = 3, tile_table: str | None = None, buckets: int = 64) -> Package:
    """U1 -> S5 -> P15 -> S7 -> A12 -> A8/A1 -> A2/A3 for one raster resource.
    ``layers``: pixel tables in order, a later one lies over the earlier ones;
    pixels without a time get that of the manifest.  Tiles are stored by time,
    and with ``tile_table`` as a catalog table bucketed by the tile key, which the
    zonal join reads in place.  Zones in a reference system that can't be brought
    to the grid leave an issue."""
    spark = zones.sparkSession
    start, resolution, new_dim = _start_time(spark, resource, time_dim)
    new_dim = materialize(new_dim, "time")
    at = new_dim.filter((F.col("timestamp") == parse_date_multi(F.lit(start))) & (F.col("granularity") == normalize_granularity(F.lit(resolution)))).first()["id"]
    parts = [RA.tiles_from_pixels(RA.fill_missing_time(p, at), grid, layer=n) for n, p in enumerate(layers)]
    tables = {"tiles": SK.table_replace(reduce(DataFrame.unionByName, parts), os.path.join(out_dir, "tiles"), ["fk_time_id"]),
              "time": SK.table_replace(new_dim, os.path.join(out_dir, "time"))}
    tiles = spark.read.parquet(tables["tiles"])
    if tile_table:
        tiles = RA.save_tile_table(tiles, tile_table, buckets, by_time=True)
    times = [r[0] for r in tiles.select("fk_time_id").distinct().collect()]
    seen = RA.mosaic_tiles(tiles) if len(layers) > 1 else tiles
    tables["pyramid"] = SK.table_replace(RA.overview_pyramid(seen, pyramid_levels), os.path.join(out_dir, "pyramid"))
    integrate_raster(tiles, zones, lau, nuts, grid, times, out_dir, overlaps=len(layers) > 1)
    tables |= {n: os.path.join(out_dir, n) for n in ("lau_stats", "nuts_stats")}
    name = resource.get("name") or "dataset"
    lost = Z.off_grid(zones, grid).agg(F.count(F.lit(1)).alias("n_messages")).filter("n_messages > 0")
    issues = lost.select(F.lit(name).alias("dataset"), F.lit(f"Integration error {name}").alias("name"), F.lit("Regions in another reference system than the raster were not measured.").alias("description"),
                         F.lit(SK.ISSUE_TYPE).alias("issue_type"), F.lit(None).cast("array<string>").alias("tags"), "n_messages")
    return Package(tables, new_dim, issues)


def finish_run(spark: SparkSession, registry: DataFrame, touched: DataFrame, packages: list[Package], today: str, out_dir: str) -> tuple[str, str]:
    """U2 + S11 at the end of a run: the registry with the repositories
    integrated today, and the issues that the packages left."""
    path = SK.table_replace(D.registry_upsert(registry, touched, today), os.path.join(out_dir, "registry"))
    issues = os.path.join(out_dir, "issues")
    for p in packages:
        if p.issues is not None:
            SK.append_issues(spark, p.issues, issues)
    return path, issues


def accepted_resources(v: Validation, profiles: tuple[str, ...] = (V.TABULAR, V.VECTOR, V.RASTER)) -> Iterator[tuple[str, str, dict]]:
    """(package, profile, resource) of accepted packages, in order; metadata
    only, fetched partition by partition while the run goes on."""
    ok = v.gate.filter(F.col("decision") != "skip").select("package")
    rows = (v.resources.join(ok, "package", "left_semi").filter(F.col("profile").isin(*profiles) & F.col("r").isNotNull())
            .select("package", "profile", "ridx", F.to_json("r").alias("r")).orderBy("package", "ridx"))
    for r in materialize(rows, "accepted").orderBy("package", "ridx").toLocalIterator():
        yield r["package"], r["profile"], json.loads(r["r"])


def accepted_tabular_resources(v: Validation) -> list[tuple[str, dict]]:
    """(package, resource) pairs of accepted tabular packages."""
    return [(package, r) for package, _, r in accepted_resources(v, (V.TABULAR,))]


@dataclass
class Run:
    """Table folders that a run left behind: of every resource
    (``package/resource`` -> name -> folder), registry and issues."""
    tables: dict[str, dict[str, str]]
    registry: str
    issues: str
    time: str | None


def run_packages(spark: SparkSession, root: str, registry: DataFrame, repositories: DataFrame, nuts: DataFrame, lau: DataFrame, zones: DataFrame, grid: Grid,
                 today: str, out_dir: str, time_dim: DataFrame | None = None) -> Run:
    """A whole run over the packages below ``root``: validation and gate, every
    accepted resource by its profile (CSV, features, raster pixels), the time
    dimension handed from one to the next, then registry and issues.

    ``repositories(name, git_id)`` tells which repository a package is.  A
    resource that cannot be read leaves an issue, and the run goes on."""
    v = validate_packages(spark, root)
    issues = os.path.join(out_dir, "issues")
    SK.append_issues(spark, SK.issue_rows(v.violations, v.manifests), issues)
    tables, done, packages, time = {}, [], [], None
    for package, profile, resource in accepted_resources(v):
        name = sanitize_name_py(resource.get("name") or "dataset")
        folder, out = f"{root.rstrip('/')}/{package}", f"{out_dir.rstrip('/')}/{package}/{name}"
        try:
            if profile == V.TABULAR:
                res = integrate_tabular(spark, folder, resource, nuts, lau, time_dim, out)
                left = Package({"fact": f"{out}/fact", "time": f"{out}/time"}, res.time_dim, res.issues)
            elif profile == V.VECTOR:
                left = integrate_vector(spark, folder, resource, time_dim, out)
            else:
                pixels = spark.read.parquet(f"{folder}/{resource['path']}")
                left = integrate_raster_package([pixels], resource, grid, zones, lau, nuts, time_dim, out)
        except (PySparkException, Py4JError, ValueError, OSError) as e:
            left = Package({}, time_dim, _failure(spark, package, e))
        else:
            time = left.tables["time"]
            time_dim = spark.read.parquet(time)
            done.append(package)
            tables[f"{package}/{name}"] = left.tables
        packages.append(left)
    touched = repositories.filter(F.col("name").isin(done)) if done else repositories.limit(0)
    path, issues = finish_run(spark, registry, touched, packages, today, out_dir)
    return Run(tables, path, issues, time)


def _failure(spark: SparkSession, package: str, e: Exception) -> DataFrame:
    text = str(e).strip().splitlines()
    return spark.range(1).select(F.lit(package).alias("dataset"), F.lit(f"Integration error {package}").alias("name"), F.lit(text[0][:500] if text else type(e).__name__).alias("description"),
                                 F.lit(SK.ISSUE_TYPE).alias("issue_type"), F.lit(None).cast("array<string>").alias("tags"), F.lit(1).cast("bigint").alias("n_messages"))
