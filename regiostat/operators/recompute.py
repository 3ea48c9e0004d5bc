"""Region-subset recompute.

After the boundaries of some municipalities change, only their statistics
and those of their ancestors are recomputed; every other row is carried over.
Updates are expressed as a left join with a match flag (so a recomputed
NULL replaces an old value), and the new table is written to a new path --
the table being read is never overwritten in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat.config import NUTS_VINTAGE
from regiostat.operators import hierarchy as H
from regiostat.operators.joins import join_dimension
from regiostat.operators.raster import Grid
from regiostat.session import materialize

LAU_SET = ["count", "sum", "mean", "stddev", "min", "max"]
NUTS_SET = ["min", "max", "sum", "count", "mean"]


def region_prefix_filter(df: DataFrame, prefix: str, col: str = "comm_id") -> DataFrame:
    """``col LIKE 'prefix%'`` as ``startswith`` (pushed to Parquet)."""
    return df.filter(F.col(col).startswith(prefix))


def update_from(target: DataFrame, updates: DataFrame, keys: list[str], set_cols: list[str]) -> DataFrame:
    """``UPDATE target SET set_cols = u.set_cols FROM updates u WHERE keys``.

    ``updates`` must be unique on ``keys``.  Matched rows take the new values
    even when they are NULL; unmatched rows keep theirs.
    """
    u = updates.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in set_cols]).withColumn("_matched", F.lit(True))
    j = join_dimension(target, u, keys, "left")
    m = F.coalesce(F.col("_matched"), F.lit(False))
    return j.select(*[F.when(m, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in set_cols else F.col(c)
                      for c in target.columns])


def region_recompute_lau(lau_stats: DataFrame, fresh: DataFrame, prefix: str,
                         compat: bool = False, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """A5: replace statistics of the municipalities under ``prefix``.

    ``fresh`` holds newly computed statistics (same shape as ``lau_stats``).
    The original leaves ``sum`` out of its SET list; ``compat=True`` does the
    same, the default updates it.  ``extra_keys`` (``("dataset",)``) update
    many datasets at once.
    """
    cols = [c for c in LAU_SET if not (compat and c == "sum")]
    return update_from(lau_stats, region_prefix_filter(fresh, prefix), [*extra_keys, "fk_lau_gid", "fk_time_id"], cols)


def affected_nuts3(lau: DataFrame, prefix: str, changed: DataFrame | None = None) -> DataFrame:
    """Parents of the changed municipalities: those under ``prefix``, or of
    them only the ones in ``changed(comm_id)``."""
    under = region_prefix_filter(lau, prefix)
    if changed is not None:
        under = under.join(changed.select("comm_id"), "comm_id", "left_semi")
    return under.select(F.col("fk_nuts_gid")).distinct()


def region_recompute_nuts3(nuts3_stats: DataFrame, lau_stats: DataFrame, lau: DataFrame,
                           nuts: DataFrame, prefix: str, vintage: str = NUTS_VINTAGE,
                           compat: bool = False, extra_keys: tuple[str, ...] = (), changed: DataFrame | None = None) -> DataFrame:
    """Recompute the NUTS 3 rows that contain a changed municipality,
    from all of their (updated) municipalities, then update by key.

    ``compat=True`` follows the original: only municipalities under the
    prefix, grouped by ``nuts_id`` with the times merged, matched on
    ``nuts_id`` alone.
    """
    if compat:
        sub = region_prefix_filter(H.attach_parent(lau_stats, lau), prefix).withColumn("fk_time_id", F.lit(None).cast("bigint"))
        fresh = H.nuts3_rollup(sub, nuts, vintage).drop("fk_time_id")
        return update_from(nuts3_stats, fresh, ["nuts_id"], NUTS_SET)
    # only towns of an affected parent are read, before anything is aggregated
    near = lau.join(affected_nuts3(lau, prefix, changed), "fk_nuts_gid", "left_semi").select("comm_id", "fk_nuts_gid", "nuts_id")
    fresh = H.nuts3_rollup(lau_stats.join(near, "comm_id"), nuts, vintage, extra_keys=extra_keys)
    return update_from(nuts3_stats, fresh, [*extra_keys, "nuts_id", "fk_time_id"], NUTS_SET)


def region_recompute_upper(nuts_stats: DataFrame, lau: DataFrame, nuts: DataFrame, prefix: str,
                           vintage: str = NUTS_VINTAGE, per_child: bool = False, extra_keys: tuple[str, ...] = (), changed: DataFrame | None = None) -> DataFrame:
    """Recompute the level 0-2 ancestors of the changed NUTS 3 regions
    from their (updated) NUTS 3 rows; update on ``nuts_id, fk_nuts_gid``
    and time."""
    l3 = nuts_stats.filter(F.col("stat_levl_") == 3)
    upper = nuts_stats.filter(F.col("stat_levl_") < 3)
    codes = (affected_nuts3(lau, prefix, changed).join(nuts.select(F.col("gid").alias("fk_nuts_gid"), F.col("nuts_id").alias("child_code")), "fk_nuts_gid")
             .select("child_code"))
    anc = H.vintage_level(nuts, F.col("stat_levl_") < 3, vintage).select(
        F.col("gid").alias("a_gid"), F.col("nuts_id").alias("a_code"))
    hit = H.hierarchy_prefix_join(codes, anc, child_code="child_code").select("a_gid").distinct()
    nuts_hit = nuts.join(hit.withColumnRenamed("a_gid", "gid"), "gid", "left_semi")
    fresh = H.nuts_upper_rollup(l3, nuts_hit, vintage, per_child, extra_keys)
    return H.all_levels(l3, update_from(upper, fresh, [*extra_keys, "nuts_id", "fk_nuts_gid", "fk_time_id"], NUTS_SET), extra_keys)


def recompute_regions(lau_stats: DataFrame, nuts_stats: DataFrame, fresh_lau: DataFrame,
                      lau: DataFrame, nuts: DataFrame, prefix: str,
                      vintage: str = NUTS_VINTAGE, extra_keys: tuple[str, ...] = (), changed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """A5 -> A6 -> A7; returns (new LAU table, new NUTS table).  The region
    tables are stored once and read by all steps, and so is each level."""
    lau, nuts = materialize(lau.select("gid", "comm_id", "fk_nuts_gid", "nuts_id"), "regions_lau"), materialize(nuts, "regions_nuts")
    new_lau = materialize(region_recompute_lau(lau_stats, fresh_lau, prefix, extra_keys=extra_keys), "new_lau")
    l3 = region_recompute_nuts3(nuts_stats.filter(F.col("stat_levl_") == 3), new_lau, lau, nuts, prefix, vintage, extra_keys=extra_keys, changed=changed)
    full = materialize(H.all_levels(l3, nuts_stats.filter(F.col("stat_levl_") < 3), extra_keys), "new_nuts")
    return new_lau, region_recompute_upper(full, lau, nuts, prefix, vintage, extra_keys=extra_keys, changed=changed)


def geometry_hash(geom: str = "geom") -> Column:
    """128 bits of a geometry (reference system, type and all vertices)."""
    g = F.col(geom)
    return F.struct(F.xxhash64(g["srid"], g["type"], g["parts"]).alias("a"), F.xxhash64(g["parts"], g["type"], F.lit(1)).alias("b"))


def changed_zones(zones: DataFrame, new_geoms: DataFrame, key: str = "comm_id", geom: str = "geom") -> DataFrame:
    """``key, geom`` of the new geometries that differ from the stored ones.
    Stored geometries are not shuffled, only their hashes; an unknown key is
    no change (as in an UPDATE)."""
    old = zones.select(key, geometry_hash(geom).alias("_old"))
    new = new_geoms.select(key, geom, geometry_hash(geom).alias("_new"))
    return new.join(old, key).filter(F.col("_new") != F.col("_old")).select(key, geom)


def recompute_after_change(zones: DataFrame, new_geoms: DataFrame, tiles: DataFrame, grid: Grid, time_ids: list[int], datasets: list[str],
                           lau_stats: DataFrame, nuts_stats: DataFrame, lau: DataFrame, nuts: DataFrame, prefix: str,
                           vintage: str = NUTS_VINTAGE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """J11 + A1 + A5-A7 for all ``datasets`` of a tile table: geometries that
    really changed replace the old ones, the zones among them under ``prefix``
    are measured again in one pass over all datasets, and only they, their
    NUTS 3 parents and the ancestors of those are updated.  Returns the new
    zone, LAU and NUTS tables."""
    from regiostat.operators.zonal import zonal_stats
    new_geoms = materialize(changed_zones(zones, new_geoms), "changed_geometries")
    again = region_prefix_filter(new_geoms, prefix).join(zones.drop("geom"), "comm_id")
    fresh = materialize(zonal_stats(again, tiles, grid, time_ids, datasets=datasets), "fresh_stats")
    new_lau, new_nuts = recompute_regions(lau_stats, nuts_stats, fresh, lau, nuts, prefix, vintage, ("dataset",), changed=new_geoms)
    return geometry_update(zones, new_geoms), new_lau, new_nuts


def geometry_update(regions: DataFrame, new_geoms: DataFrame, key: str = "comm_id",
                    geom_col: str = "geom") -> DataFrame:
    """Replace region geometries by key in one job (J10 on the region table)."""
    return update_from(regions, new_geoms.select(key, geom_col), [key], [geom_col])
