"""Hierarchy and rollup queries (stage 1-2) over the derived fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiostat.operators import hierarchy as H
from regiostat.plans.fixture_sql import duck_mean, with_ctes
from regiostat.plans.fixtures import Fixtures
from regiostat.plans.registry import register

# -- DuckDB building blocks ---------------------------------------------------
def stat_sql(rows: str) -> str:
    """Statistics of a group of rows ``rows``: extremes of extremes, sums of
    sums, and the mean that follows from the two sums."""
    total, n = f"CAST(sum({rows}.sum) AS DECIMAL(20,2))", f"CAST(sum({rows}.count) AS BIGINT)"
    extremes = ", ".join(f"CAST({f}({rows}.{f}) AS DECIMAL(20,2)) AS {f}" for f in ("min", "max"))
    return f"{extremes}, {total} AS sum, {n} AS count, {duck_mean(total, n)} AS mean"


def level_sql(condition: str) -> str:
    """Regions of a level in the current vintage."""
    return f"(SELECT gid, nuts_id, stat_levl_ FROM nuts WHERE {condition} AND year = DATE '2013-01-01')"


def nuts3_sql(stats: str = "lau_stats", towns: str = "lau", keys: str = "") -> str:
    """A level-3 region gathers the towns that name it as their parent."""
    first = f"{keys}, " if keys else ""
    return f"""SELECT {first}{stat_sql('town')}, home.nuts_id, home.stat_levl_, town.fk_time_id, home.gid AS fk_nuts_gid
FROM (SELECT stat.*, place.fk_nuts_gid AS home_gid FROM {stats} AS stat JOIN {towns} AS place USING (comm_id)) AS town
JOIN {level_sql('stat_levl_ = 3')} AS home ON home.gid = town.home_gid
GROUP BY {first}home.nuts_id, home.stat_levl_, town.fk_time_id, home.gid"""


def upper_sql(level3: str, per_child: bool = False, keys: str = "") -> str:
    """A higher region gathers the level-3 rows whose code begins with its
    own; ``per_child`` keeps one row for each of them."""
    first = f"{keys}, " if keys else ""
    own = "part.fk_nuts_gid" if per_child else "area.gid"
    return f"""SELECT {first}{stat_sql('part')}, area.nuts_id, area.stat_levl_, part.fk_time_id, {own} AS fk_nuts_gid
FROM (SELECT * FROM ({level3}) WHERE count IS NOT NULL) AS part
JOIN {level_sql('stat_levl_ < 3')} AS area ON left(part.nuts_id, length(area.nuts_id)) = area.nuts_id
GROUP BY {first}area.nuts_id, area.stat_levl_, part.fk_time_id, {own}"""


def all_levels_sql(stats: str = "lau_stats", towns: str = "lau", keys: str = "") -> str:
    level3 = nuts3_sql(stats, towns, keys)
    return f"SELECT * FROM ({level3}) UNION ALL SELECT * FROM ({upper_sql(level3, keys=keys)})"


FX = ["nuts", "lau", "lau_stats"]


@register("nuts3_rollup", with_ctes(FX, nuts3_sql()))
def q_nuts3_rollup(spark, sf):
    fx = Fixtures(spark, sf)
    return H.nuts3_rollup(H.attach_parent(fx.lau_stats(), fx.lau()), fx.nuts())


@register("stats_to_region_join", with_ctes(FX, """
SELECT stat.*, place.fk_nuts_gid, place.nuts_id FROM lau_stats AS stat LEFT JOIN lau AS place USING (comm_id)"""))
def q_stats_to_region_join(spark, sf):
    fx = Fixtures(spark, sf)
    return H.attach_parent(fx.lau_stats(), fx.lau())


@register("region_right_join", with_ctes(["nuts", "lau"], """
SELECT lau.gid AS lau_gid, lau.comm_id, n.gid AS nuts_gid, n.nuts_id, n.stat_levl_
FROM nuts n RIGHT JOIN lau ON lau.fk_nuts_gid = n.gid
WHERE n.stat_levl_ = 3 AND n.year = DATE '2013-01-01'"""))
def q_region_right_join(spark, sf):
    fx = Fixtures(spark, sf)
    n = fx.nuts()
    lau = fx.lau().select(F.col("gid").alias("lau_gid"), "comm_id", "fk_nuts_gid")
    j = n.join(lau, lau.fk_nuts_gid == n.gid, "right").filter(
        (F.col("stat_levl_") == 3) & (F.col("year") == F.lit("2013-01-01").cast("date")))
    return j.select("lau_gid", "comm_id", F.col("gid").alias("nuts_gid"), "nuts_id", "stat_levl_")


@register("hierarchy_prefix_join", with_ctes(["nuts"], """
SELECT c.gid AS child_gid, c.nuts_id AS child_id, a.gid AS a_gid, a.nuts_id AS a_code
FROM nuts c JOIN nuts a ON c.nuts_id LIKE a.nuts_id || '%'
WHERE c.stat_levl_ = 3 AND a.stat_levl_ < 3 AND a.year = DATE '2013-01-01'"""))
def q_hierarchy_prefix_join(spark, sf):
    fx = Fixtures(spark, sf)
    n = fx.nuts()
    c = n.filter("stat_levl_ = 3").select(F.col("gid").alias("child_gid"), F.col("nuts_id").alias("child_id"))
    a = H.vintage_level(n, F.col("stat_levl_") < 3).select(F.col("gid").alias("a_gid"),
                                                          F.col("nuts_id").alias("a_code"))
    return H.hierarchy_prefix_join(c, a, child_code="child_id")


def _l3(spark, sf, stats="lau_stats"):
    fx = Fixtures(spark, sf)
    s = fx.lau_stats(times=3) if stats == "lau_stats_t3" else fx.lau_stats()
    return fx, H.nuts3_rollup(H.attach_parent(s, fx.lau()), fx.nuts())


@register("nuts_upper_rollup", with_ctes(FX, upper_sql(nuts3_sql())))
def q_nuts_upper_rollup(spark, sf):
    fx, l3 = _l3(spark, sf)
    return H.nuts_upper_rollup(l3, fx.nuts())


@register("nuts_upper_per_child", with_ctes(FX, upper_sql(nuts3_sql(), per_child=True)))
def q_nuts_upper_per_child(spark, sf):
    fx, l3 = _l3(spark, sf)
    return H.nuts_upper_rollup(l3, fx.nuts(), per_child=True)


@register("all_levels", with_ctes(FX, all_levels_sql()))
def q_all_levels(spark, sf):
    fx = Fixtures(spark, sf)
    return H.rollup_all(fx.lau_stats(), fx.lau(), fx.nuts())


@register("all_levels_multi_time", with_ctes(["nuts", "lau", "lau_stats_t3"], all_levels_sql("lau_stats_t3")))
def q_all_levels_multi_time(spark, sf):
    fx = Fixtures(spark, sf)
    return H.rollup_all(fx.lau_stats(times=3), fx.lau(), fx.nuts())


@register("level_year_filter", with_ctes(["nuts"], """
SELECT gid, nuts_id, stat_levl_ FROM nuts WHERE stat_levl_ < 3 AND year = DATE '2013-01-01'"""))
def q_level_year_filter(spark, sf):
    n = Fixtures(spark, sf).nuts()
    return H.vintage_level(n, F.col("stat_levl_") < 3).select("gid", "nuts_id", "stat_levl_")


@register("non_null_stats_filter", with_ctes(FX, f"SELECT * FROM ({nuts3_sql()}) WHERE count IS NOT NULL"))
def q_non_null_stats_filter(spark, sf):
    _, l3 = _l3(spark, sf)
    return l3.filter(F.col("count").isNotNull())


@register("weighted_mean", with_ctes(FX, f"""
SELECT nuts_id, fk_time_id, sum, count, {duck_mean('sum', 'count')} AS mean2 FROM ({nuts3_sql()})"""))
def q_weighted_mean(spark, sf):
    from regiostat.functions.decimals import exact_mean
    _, l3 = _l3(spark, sf)
    return l3.select("nuts_id", "fk_time_id", "sum", "count", exact_mean("sum", "count").alias("mean2"))
