"""Repository selection.

The original walks a hosting service's API in Python loops; here the
repository list, commit log and deny list are tables and the selection is
semi/anti joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiostat.operators.joins import join_dimension


def changed_repositories(repos: DataFrame, commits: DataFrame, since) -> DataFrame:
    """Repositories with a commit at or after ``since``."""
    recent = commits.filter(F.col("ts") >= F.lit(since)).select("git_id").distinct()
    return join_dimension(repos, recent, "git_id", "left_semi")


def search_repositories(requests: DataFrame, repos: DataFrame) -> DataFrame:
    """Each requested name -> first repository whose name contains it
    (smallest ``git_id``), NULL when none.

    ``contains`` as an equi-join: names are exploded into their substrings of
    just the lengths that are requested (a handful, at most the length of the
    longest name) and joined on equality; a request that very many names
    contain is reduced by a partial minimum.  Work is linear in both tables."""
    req = requests.select(F.col("request")).distinct()
    lengths = [r[0] for r in req.select(F.length("request")).distinct().collect() if r[0] is not None]
    pieces = [_substrings(n) for n in lengths]
    if not pieces:
        return req.select("request", F.lit(None).cast(repos.schema["git_id"].dataType).alias("git_id"), F.lit(None).cast("string").alias("name"))
    hits = repos.select("git_id", "name", F.explode(F.array_distinct(F.concat(*pieces))).alias("request"))
    first = hits.groupBy("request").agg(F.min(F.struct("git_id", "name")).alias("r")).select("request", "r.git_id", "r.name")
    return req.join(first, "request", "left")


def _substrings(n: int):
    """All substrings of ``name`` of length ``n``."""
    none = F.expr("CAST(array() AS array<string>)")
    if n == 0:
        return F.array(F.lit(""))
    every = F.transform(F.sequence(F.lit(1), F.length("name") - (n - 1)), lambda i: F.substring(F.col("name"), i, F.lit(n)))
    return F.when(F.length("name") >= n, every).otherwise(none)


def deny_list(repos: DataFrame, denied: DataFrame, col: str = "name") -> DataFrame:
    """Drop repositories (or resources) named in the deny table."""
    return join_dimension(repos, denied.select(F.col(col)).distinct(), col, "left_anti")


def visibility_filter(repos: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(public repositories, the others as issue rows)."""
    pub = repos.filter(F.col("visibility") == "public")
    issues = repos.filter(F.col("visibility") != "public").select(
        F.col("name").alias("dataset"), F.concat(F.lit("Repository not public - "), "name").alias("name"),
        F.lit("Repository is not public and was skipped.").alias("description"),
        F.lit("Integration warning").alias("issue_type"))
    return pub, issues


def subgroup_union(groups: list[DataFrame]) -> DataFrame:
    """Repositories of a group plus those of its subgroups."""
    return reduce(lambda a, b: a.unionByName(b), groups)
