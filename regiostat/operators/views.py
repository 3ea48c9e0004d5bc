"""Published layer views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_colliding_columns(fact: DataFrame, region: DataFrame) -> list[str]:
    """Fact columns whose (case-insensitive) name is not a region column."""
    taken = {c.lower() for c in region.columns}
    return [c for c in fact.columns if c.lower() not in taken]


def layer_view(fact: DataFrame, time_dim: DataFrame | None, region: DataFrame | None,
               region_key: str = "fk_nuts_gid") -> DataFrame:
    """Fact LEFT JOIN time (adds ``timestamp``) LEFT JOIN region (adds all
    region columns).  A join is made only when the fact carries that key
    column (the original decides by whether any row got a key)."""
    cols = drop_colliding_columns(fact, region) if region is not None else list(fact.columns)
    out = fact.select(*cols, *([F.col(region_key).alias("_rk")] if region is not None and region_key in
                              fact.columns and region_key not in cols else []))
    rk = region_key if region_key in cols else "_rk"
    if time_dim is not None and "fk_time_id" in fact.columns:
        t = time_dim.select(F.col("id").alias("_tid"), F.col("timestamp").alias("timestamp"))
        out = out.join(t, F.col("fk_time_id") == F.col("_tid"), "left").drop("_tid")
    if region is not None and rk in out.columns:
        r = region.select(*[F.col(c).alias(c) for c in region.columns], F.col("gid").alias("_rgid"))
        out = out.join(r, F.col(rk) == F.col("_rgid"), "left").drop("_rgid")
        if rk == "_rk":
            out = out.drop("_rk")
    return out


def layer_view_sql(fact_path: str, fact_columns: list[str], time_path: str, region_path: str, region_columns: list[str],
                   region_key: str = "fk_nuts_gid") -> str:
    """J7 as SQL over stored tables, for a view in the catalog."""
    taken = {c.lower() for c in region_columns}
    cols = [f"f.`{c}`" for c in fact_columns if c.lower() not in taken] + ["t.`timestamp`"] + [f"r.`{c}`" for c in region_columns]
    return (f"SELECT {', '.join(cols)} FROM parquet.`{fact_path}` f LEFT JOIN parquet.`{time_path}` t ON f.fk_time_id = t.id "
            f"LEFT JOIN parquet.`{region_path}` r ON f.`{region_key}` = r.gid")


def theme_projections(view: DataFrame, themes: dict[str, list[str]]) -> dict[str, DataFrame]:
    """Several fixed projections of one table; ``-`` in column names
    becomes ``_``."""
    return {name: view.select(*[F.col(c.replace("-", "_")) for c in cols]) for name, cols in themes.items()}
