"""Region hierarchy operators: parent lookup and rollups.

Statistics move up the hierarchy from stored rows of the level below, never
from pixels: municipality (LAU) rows give NUTS 3, NUTS 3 rows give NUTS 0-2.
Each level is one hash aggregation with a map-side partial step, so a region
that holds a large share of the rows does not concentrate in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiostat.config import NUTS_VINTAGE
from regiostat.functions.decimals import exact_mean, to_stat
from regiostat.operators.joins import join_dimension, prefixes
from regiostat.session import materialize

NUTS_STAT_COLUMNS = ["min", "max", "sum", "count", "mean", "nuts_id", "stat_levl_",
                     "fk_time_id", "fk_nuts_gid"]


def _rollup_aggs():
    return [to_stat(F.min("min")).alias("min"), to_stat(F.max("max")).alias("max"),
            to_stat(F.sum("sum")).alias("sum"), F.sum("count").cast("bigint").alias("count")]


def attach_parent(lau_stats: DataFrame, lau: DataFrame, key: str = "comm_id") -> DataFrame:
    """``stats LEFT JOIN lau ON comm_id`` -> adds ``fk_nuts_gid, nuts_id``."""
    parents = lau.select(key, "fk_nuts_gid", "nuts_id")
    return join_dimension(lau_stats, parents, key, "left")


def vintage_level(nuts: DataFrame, level_pred, vintage: str = NUTS_VINTAGE) -> DataFrame:
    """Hierarchy level and vintage filter on the region table."""
    return nuts.filter(level_pred & (F.col("year") == F.lit(vintage).cast("date")))


def nuts3_rollup(lau_with_parent: DataFrame, nuts: DataFrame, vintage: str = NUTS_VINTAGE,
                 level: int = 3, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """J5 + A2: municipality rows -> one row per (NUTS 3 region, time).

    The original right join is followed by a NULL-rejecting filter on the
    region side, so it is an inner join.  Municipalities whose statistics
    are all NULL give a NUTS 3 row with NULL statistics.
    """
    n = vintage_level(nuts, F.col("stat_levl_") == level, vintage).select(
        F.col("gid").alias("n_gid"), F.col("nuts_id").alias("n_nuts_id"), "stat_levl_")
    j = join_dimension(lau_with_parent.drop("nuts_id", "stat_levl_"), n,
                       F.col("fk_nuts_gid") == F.col("n_gid"), "inner")
    agg = j.groupBy(*extra_keys, "n_gid", "n_nuts_id", "stat_levl_", "fk_time_id").agg(*_rollup_aggs())
    return agg.select(*extra_keys, "min", "max", "sum", "count", exact_mean("sum", "count").alias("mean"),
                      F.col("n_nuts_id").alias("nuts_id"), "stat_levl_", "fk_time_id",
                      F.col("n_gid").alias("fk_nuts_gid"))


def hierarchy_prefix_join(children: DataFrame, ancestors: DataFrame,
                          child_code: str = "nuts_id", ancestor_code: str = "a_code") -> DataFrame:
    """``child LIKE ancestor || '%'`` as an equi-join.

    Each child row is exploded into its code prefixes (bounded by the code
    length) and joined on equality, so the plan is a hash/sort-merge join,
    never a cartesian product.
    """
    keyed = children.withColumn("_prefix", F.explode(prefixes(F.col(child_code))))
    return join_dimension(keyed, ancestors, F.col("_prefix") == F.col(ancestor_code), "inner").drop("_prefix")


def nuts_upper_rollup(nuts_stats: DataFrame, nuts: DataFrame, vintage: str = NUTS_VINTAGE,
                      per_child: bool = False, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """A3 (default) / A4 (``per_child=True``): NUTS 3 rows -> levels 0-2.

    A3 emits one row per (ancestor, time).  A4 reproduces the query as it is
    written in the original, whose grouping key also holds the child's
    ``fk_nuts_gid``, i.e. one row per (ancestor, NUTS 3 child, time).
    """
    n3 = nuts_stats.filter((F.col("stat_levl_") == 3) & F.col("count").isNotNull()).select(
        *extra_keys, "min", "max", "sum", "count", "nuts_id", "fk_time_id",
        F.col("fk_nuts_gid").alias("child_gid"))
    anc = vintage_level(nuts, F.col("stat_levl_") < 3, vintage).select(
        F.col("gid").alias("a_gid"), F.col("nuts_id").alias("a_code"), F.col("stat_levl_").alias("a_lvl"))
    j = hierarchy_prefix_join(n3, anc)
    keys = [*extra_keys, "a_gid", "a_code", "a_lvl", "fk_time_id"] + (["child_gid"] if per_child else [])
    agg = j.groupBy(*keys).agg(*_rollup_aggs())
    return agg.select(*extra_keys, "min", "max", "sum", "count", exact_mean("sum", "count").alias("mean"),
                      F.col("a_code").alias("nuts_id"), F.col("a_lvl").alias("stat_levl_"), "fk_time_id",
                      F.col("child_gid" if per_child else "a_gid").alias("fk_nuts_gid"))


def all_levels(level3: DataFrame, upper: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Level 3 and levels 0-2 in one table (UNION ALL)."""
    cols = [*extra_keys, *NUTS_STAT_COLUMNS]
    return level3.select(*cols).unionByName(upper.select(*cols))


def rollup_all(lau_stats: DataFrame, lau: DataFrame, nuts: DataFrame,
               vintage: str = NUTS_VINTAGE, per_child: bool = False,
               extra_keys: tuple[str, ...] = (), materialize_level3: bool = True) -> DataFrame:
    """LAU statistics -> NUTS 3 -> NUTS 0-2, as one table.  ``extra_keys``
    (e.g. ``("dataset",)``) run many datasets through one plan.

    The NUTS 3 table feeds both the output and the upper levels; it is
    computed once and checkpointed (it is small: regions x times)."""
    l3 = nuts3_rollup(attach_parent(lau_stats, lau), nuts, vintage, extra_keys=extra_keys)
    if materialize_level3:
        l3 = materialize(l3)
    return all_levels(l3, nuts_upper_rollup(l3, nuts, vintage, per_child, extra_keys), extra_keys)
