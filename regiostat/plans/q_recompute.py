"""Region-subset recompute, dataset batch and referential queries (stage 2)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiostat.config import DEFAULT_SRID
from regiostat.operators import checks as C
from regiostat.operators import hierarchy as H
from regiostat.operators import recompute as R
from regiostat.operators import zonal as Z
from regiostat.plans.fixture_sql import with_ctes
from regiostat.plans.fixtures import RECOMPUTE_PREFIX, SCALED_PREFIX, Fixtures
from regiostat.plans.q_hierarchy import all_levels_sql, level_sql, nuts3_sql, stat_sql
from regiostat.plans.registry import register
from regiostat.session import materialize, staging_path

LAU_COLS = "count, sum, mean, stddev, min, max, comm_id, fk_time_id, fk_lau_gid"


@register("region_prefix_filter", with_ctes(["lau_stats"], f"SELECT {LAU_COLS} FROM lau_stats WHERE comm_id LIKE 'C1%'"))
def q_region_prefix_filter(spark, sf):
    return R.region_prefix_filter(Fixtures(spark, sf).lau_stats(), RECOMPUTE_PREFIX)


@register("update_from", with_ctes(["lau_stats", "lau_stats_new"], """
SELECT CASE WHEN n.fk_lau_gid IS NOT NULL THEN n.count ELSE o.count END AS count,
       CASE WHEN n.fk_lau_gid IS NOT NULL THEN n.max ELSE o.max END AS max,
       o.sum, o.comm_id, o.fk_lau_gid
FROM lau_stats o LEFT JOIN (SELECT * FROM lau_stats_new WHERE fk_lau_gid % 5 = 0) n
  ON o.fk_lau_gid = n.fk_lau_gid"""))
def q_update_from(spark, sf):
    fx = Fixtures(spark, sf)
    old = fx.lau_stats().select("count", "max", "sum", "comm_id", "fk_lau_gid")
    new = fx.lau_stats(even_only=True).filter(F.col("fk_lau_gid") % 5 == 0)
    return R.update_from(old, new, ["fk_lau_gid"], ["count", "max"])


@register("region_recompute_lau", with_ctes(["lau_upd"], f"SELECT {LAU_COLS} FROM lau_upd"))
def q_region_recompute_lau(spark, sf):
    fx = Fixtures(spark, sf)
    return R.region_recompute_lau(fx.lau_stats(), fx.lau_stats(even_only=True), RECOMPUTE_PREFIX)


@register("region_recompute_lau_compat", with_ctes(["lau_upd_compat"], f"SELECT {LAU_COLS} FROM lau_upd_compat"))
def q_region_recompute_lau_compat(spark, sf):
    fx = Fixtures(spark, sf)
    return R.region_recompute_lau(fx.lau_stats(), fx.lau_stats(even_only=True), RECOMPUTE_PREFIX, compat=True)


def _recompute_inputs(spark, sf):
    """The stored tables that an update starts from."""
    fx = Fixtures(spark, sf)
    old_lau = materialize(fx.lau_stats(), "lau_stats")
    old_nuts = materialize(H.rollup_all(old_lau, fx.lau(), fx.nuts()), "nuts_stats")
    return fx, old_lau, old_nuts


@register("region_recompute_nuts3", with_ctes(["nuts", "lau", "lau_upd"], nuts3_sql("lau_upd")))
def q_region_recompute_nuts3(spark, sf):
    fx, old_lau, old_nuts = _recompute_inputs(spark, sf)
    new_lau = R.region_recompute_lau(old_lau, fx.lau_stats(even_only=True), RECOMPUTE_PREFIX)
    return R.region_recompute_nuts3(old_nuts.filter("stat_levl_ = 3"), new_lau, fx.lau(), fx.nuts(),
                                    RECOMPUTE_PREFIX)


@register("region_recompute_upper", with_ctes(["nuts", "lau", "lau_upd"], all_levels_sql("lau_upd")))
def q_region_recompute_upper(spark, sf):
    fx, old_lau, old_nuts = _recompute_inputs(spark, sf)
    _, new_nuts = R.recompute_regions(old_lau, old_nuts, fx.lau_stats(even_only=True), fx.lau(), fx.nuts(),
                                      RECOMPUTE_PREFIX)
    return new_nuts


DATASET_LIST_SCHEMA = T.StructType([T.StructField("dataset_name", T.StringType()),
                                    T.StructField("srid", T.IntegerType())])


def dataset_list(spark, sf):
    """The parameter table (dataset_name, srid), staged as CSV in the
    shared folder and read back with an explicit schema."""
    names = (Fixtures(spark, sf).dataset_stats().select(F.col("dataset").alias("dataset_name")).distinct()
             .withColumn("srid", F.lit(DEFAULT_SRID)))
    path = staging_path(spark, "dataset_list")
    names.write.mode("overwrite").option("header", True).csv(path)
    return spark.read.schema(DATASET_LIST_SCHEMA).option("header", True).csv(path)


DS_SQL = """SELECT DISTINCT 'ds_' || regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '_', 'g') AS dataset_name,
CAST(3035 AS INTEGER) AS srid FROM orders"""


@register("dataset_list_scan", DS_SQL)
def q_dataset_list_scan(spark, sf):
    return dataset_list(spark, sf)


@register("recompute_batch", with_ctes(["nuts", "slau", "dszonal_upd"], all_levels_sql("dszonal_upd", "slau", keys="dataset")))
def q_recompute_batch(spark, sf):
    """Geometries come in anew; the tables of all datasets of the parameter
    table are updated in one run, from the pixels of the zones that really
    changed up to level 0, ``dataset`` a key in every step."""
    fx = Fixtures(spark, sf)
    todo = [r["dataset_name"] for r in dataset_list(spark, sf).collect()]  # the parameter table
    grid = fx.scaled_grid()
    tiles, zones = materialize(fx.dataset_tiles(), "tiles"), materialize(fx.scaled_zones(), "zones")
    lau, nuts = materialize(fx.scaled_lau(), "scaled_lau"), materialize(fx.nuts(), "nuts")
    old = materialize(Z.zonal_stats(zones, tiles, grid, [1], datasets=todo), "lau_stats")
    levels = materialize(H.rollup_all(old, lau, nuts, extra_keys=("dataset",)), "nuts_stats")
    return R.recompute_after_change(zones, fx.scaled_geoms(), tiles, grid, [1], todo, old, levels, lau, nuts, SCALED_PREFIX)[2]


@register("referential_check", with_ctes(["nuts", "lau", "lau_stats"], """
SELECT 'lau_stats.fk_lau_gid' AS fk, CAST(count(*) AS BIGINT) AS orphans FROM lau_stats
  WHERE fk_lau_gid IS NOT NULL AND fk_lau_gid NOT IN (SELECT gid FROM lau)
UNION ALL SELECT 'lau.fk_nuts_gid', count(*) FROM lau
  WHERE fk_nuts_gid IS NOT NULL AND fk_nuts_gid NOT IN (SELECT gid FROM nuts)
UNION ALL SELECT 'orders.o_custkey', count(*) FROM orders
  WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'lineitem.l_partkey', count(*) FROM lineitem
  WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'lineitem.l_suppkey', count(*) FROM lineitem
  WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier)"""))
def q_referential_check(spark, sf):
    fx = Fixtures(spark, sf)
    li = fx.t("lineitem")
    return C.referential_report([
        ("lau_stats.fk_lau_gid", fx.lau_stats(), fx.lau(), "fk_lau_gid", "gid"),
        ("lau.fk_nuts_gid", fx.lau(), fx.nuts(), "fk_nuts_gid", "gid"),
        ("orders.o_custkey", fx.t("orders"), fx.t("customer"), "o_custkey", "c_custkey"),
        ("lineitem.l_partkey", li, fx.t("part"), "l_partkey", "p_partkey"),
        ("lineitem.l_suppkey", li, fx.t("supplier"), "l_suppkey", "s_suppkey"),
    ])


@register("fk_set_null", with_ctes(["lau_stats_t3"], """
SELECT s.count, s.comm_id, CASE WHEN s.fk_time_id IN (SELECT DISTINCT 1 + o_orderkey % 3 FROM orders
  WHERE 1 + o_orderkey % 3 < 3) THEN s.fk_time_id END AS fk_time_id FROM lau_stats_t3 s"""))
def q_fk_set_null(spark, sf):
    fx = Fixtures(spark, sf)
    times = (fx.t("orders").select((F.lit(1) + F.col("o_orderkey") % 3).cast("bigint").alias("id"))
             .filter("id < 3"))
    return C.set_null_on_delete(fx.lau_stats(times=3).select("count", "comm_id", "fk_time_id"), times,
                                "fk_time_id", "id")


def _compat_nuts3_sql() -> str:
    names = ["min", "max", "sum", "count", "mean"]
    part = f"""SELECT {stat_sql('town')}, home.nuts_id
FROM (SELECT stat.*, place.fk_nuts_gid AS home_gid FROM lau_upd AS stat JOIN lau AS place USING (comm_id)
      WHERE starts_with(comm_id, 'C1')) AS town
JOIN {level_sql('stat_levl_ = 3')} AS home ON home.gid = town.home_gid GROUP BY home.nuts_id"""
    sets = ", ".join(f"CASE WHEN hit THEN part.{c} ELSE kept.{c} END AS {c}" for c in names)
    return with_ctes(["nuts", "lau", "lau_stats", "lau_upd"], f"""
SELECT {sets}, nuts_id, kept.stat_levl_, kept.fk_time_id, kept.fk_nuts_gid
FROM ({nuts3_sql('lau_stats')}) AS kept LEFT JOIN (SELECT *, true AS hit FROM ({part})) AS part USING (nuts_id)""")


@register("region_recompute_nuts3_compat", _compat_nuts3_sql())
def q_region_recompute_nuts3_compat(spark, sf):
    """A6 as written in the original: only the prefixed municipalities,
    grouped by ``nuts_id`` with the times merged, matched on ``nuts_id``."""
    fx, old_lau, old_nuts = _recompute_inputs(spark, sf)
    new_lau = R.region_recompute_lau(old_lau, fx.lau_stats(even_only=True), RECOMPUTE_PREFIX)
    return R.region_recompute_nuts3(old_nuts.filter("stat_levl_ = 3"), new_lau, fx.lau(), fx.nuts(),
                                    RECOMPUTE_PREFIX, compat=True)
