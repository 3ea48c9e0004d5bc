"""Repository selection and registry queries over the B.10 fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiostat.operators import dims as D
from regiostat.operators import repos as RP
from regiostat.plans.fixture_sql import cte, with_ctes
from regiostat.plans.fixtures import Fixtures
from regiostat.plans.registry import register

# Deny list of the fixture and the registry dates.
DENIED = ["Supplier#000000001", "Supplier#000000002", "Supplier#000000003", "Supplier#000000004",
          "Supplier#000000005"]
REGISTRY_CREATED = "2020-01-01 00:00:00"
TODAY = "2024-01-01 00:00:00"


def repos(spark, sf):
    s = Fixtures(spark, sf).t("supplier")
    return s.select(F.col("s_suppkey").alias("git_id"), F.col("s_name").alias("name"),
                    F.when(F.col("s_nationkey") % 5 == 0, "private").otherwise("public").alias("visibility"))


def commits(spark, sf):
    li = Fixtures(spark, sf).t("lineitem")
    return li.select(F.col("l_suppkey").alias("git_id"), F.col("l_shipdate").alias("ts"))


def since(spark, sf):
    """Latest commit minus 30 days (one scalar aggregate)."""
    return commits(spark, sf).agg(F.timestamp_add("DAY", F.lit(-30), F.max("ts"))).first()[0]


cte("repos", [], """SELECT s_suppkey AS git_id, s_name AS name,
  CASE WHEN s_nationkey % 5 = 0 THEN 'private' ELSE 'public' END AS visibility FROM supplier""")
cte("changed", ["repos"], """
SELECT * FROM repos WHERE git_id IN (SELECT l_suppkey FROM lineitem
  WHERE l_shipdate >= (SELECT max(l_shipdate) - INTERVAL 30 DAY FROM lineitem))""")


@register("changed_repositories", with_ctes(["changed"], "SELECT git_id, name, visibility FROM changed"))
def q_changed_repositories(spark, sf):
    return RP.changed_repositories(repos(spark, sf), commits(spark, sf), since(spark, sf))


cte("requests", [], """
SELECT substr(s_name, 13) AS request FROM supplier WHERE s_suppkey % 10 = 0
UNION ALL SELECT 'missing_repo_' || CAST(n_nationkey AS VARCHAR) FROM nation WHERE n_nationkey < 3""")


def requests(spark, sf):
    fx = Fixtures(spark, sf)
    a = fx.t("supplier").filter(F.col("s_suppkey") % 10 == 0).select(F.expr("substring(s_name, 13)").alias("request"))
    b = fx.t("nation").filter(F.col("n_nationkey") < 3).select(
        F.concat(F.lit("missing_repo_"), F.col("n_nationkey").cast("string")).alias("request"))
    return a.unionByName(b)


@register("search_repositories", with_ctes(["requests", "repos"], """
SELECT q.request, h.git_id, h.name FROM (SELECT DISTINCT request FROM requests) q LEFT JOIN (
  SELECT request, min(git_id) AS git_id, arg_min(name, git_id) AS name FROM (SELECT DISTINCT request FROM requests) q2
  JOIN repos r ON contains(r.name, q2.request) GROUP BY request) h ON h.request = q.request"""))
def q_search_repositories(spark, sf):
    return RP.search_repositories(requests(spark, sf), repos(spark, sf))


@register("deny_list", with_ctes(["repos"], "SELECT git_id, name, visibility FROM repos WHERE name NOT IN ("
                                 + ", ".join(f"'{d}'" for d in DENIED) + ")"))
def q_deny_list(spark, sf):
    denied = spark.createDataFrame([(d,) for d in DENIED], "name string")
    return RP.deny_list(repos(spark, sf), denied)


@register("visibility_filter", with_ctes(["repos"], "SELECT git_id, name, visibility FROM repos "
                                         "WHERE visibility = 'public'"))
def q_visibility_filter(spark, sf):
    return RP.visibility_filter(repos(spark, sf))[0]


@register("subgroup_union", with_ctes(["repos"], "SELECT git_id, name, visibility FROM repos"))
def q_subgroup_union(spark, sf):
    r = repos(spark, sf)
    return RP.subgroup_union([r.filter(F.col("git_id") % 2 == 0), r.filter(F.col("git_id") % 2 == 1)])


cte("registry", [], f"""
SELECT row_number() OVER (ORDER BY s_suppkey) AS id, s_name AS name, s_suppkey AS git_id,
  TIMESTAMP '{REGISTRY_CREATED}' AS created, TIMESTAMP '{REGISTRY_CREATED}' AS updated
FROM supplier WHERE s_suppkey % 3 = 0""")


@register("registry_upsert", with_ctes(["registry", "changed"], f"""
SELECT r.id, r.name, r.git_id, r.created,
  CASE WHEN t.git_id IS NOT NULL THEN TIMESTAMP '{TODAY}' ELSE r.updated END AS updated
FROM registry r LEFT JOIN changed t ON t.name = r.name AND t.git_id = r.git_id
UNION ALL
SELECT (SELECT max(id) FROM registry) + row_number() OVER (ORDER BY t.git_id, t.name), t.name, t.git_id,
  TIMESTAMP '{TODAY}', TIMESTAMP '{TODAY}'
FROM changed t WHERE NOT EXISTS (SELECT 1 FROM registry r WHERE r.name = t.name AND r.git_id = t.git_id)"""))
def q_registry_upsert(spark, sf):
    s = Fixtures(spark, sf).t("supplier").filter(F.col("s_suppkey") % 3 == 0)
    day = F.lit(REGISTRY_CREATED).cast("timestamp_ntz")
    reg = D.dense_id(s.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("git_id"),
                              day.alias("created"), day.alias("updated")), ["git_id"])
    touched = RP.changed_repositories(repos(spark, sf), commits(spark, sf), since(spark, sf))
    return D.registry_upsert(reg, touched, TODAY)
