"""Referential checks (J13), re-aimed from foreign-key DDL to data checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiostat.operators.joins import join_dimension


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (``left_anti``)."""
    keys = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return join_dimension(child.filter(F.col(child_key).isNotNull()), keys, child_key, "left_anti")


def referential_report(checks: list[tuple[str, DataFrame, DataFrame, str, str]]) -> DataFrame:
    """One row per foreign key: ``(fk, orphans)``."""
    parts = [orphans(c, p, ck, pk).agg(F.count(F.lit(1)).alias("orphans")).select(F.lit(name).alias("fk"), "orphans")
             for name, c, p, ck, pk in checks]
    return reduce(DataFrame.unionByName, parts)


def set_null_on_delete(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """``ON DELETE SET NULL``: keys without a parent become NULL."""
    keys = parent.select(F.col(parent_key).alias(child_key)).distinct().withColumn("_has_parent", F.lit(True))
    j = join_dimension(child, keys, child_key, "left")
    return j.select(*[F.when(F.col("_has_parent"), F.col(c)).alias(c) if c == child_key else F.col(c)
                      for c in child.columns])
