from decimal import Decimal

from pyspark.sql import functions as F

from core_helpers import plan_text
from regiostat.operators import hierarchy as H

D = Decimal
NUTS = [(1, "AA", 0, "2013-01-01"), (900001, "AA", 0, "2010-01-01"), (100, "AAB", 1, "2013-01-01"),
        (1000, "AAB0", 2, "2013-01-01"), (10000, "AAB01", 3, "2013-01-01"), (10001, "AAB02", 3, "2013-01-01")]
LAU = [(1, "L1", 10000, "AAB01"), (2, "L2", 10000, "AAB01"), (3, "L3", 10001, "AAB02")]


def frames(spark, stats):
    nuts = spark.createDataFrame(NUTS, "gid long, nuts_id string, stat_levl_ int, year string").withColumn(
        "year", F.col("year").cast("date"))
    lau = spark.createDataFrame(LAU, "gid long, comm_id string, fk_nuts_gid long, nuts_id string")
    st = spark.createDataFrame(stats, "count long, sum decimal(20,2), mean decimal(20,2), stddev decimal(20,2), "
                                      "min decimal(20,2), max decimal(20,2), comm_id string, fk_time_id long, "
                                      "fk_lau_gid long")
    return nuts, lau, st


def test_nuts3_rollup_weighted_mean_and_null_region(spark):
    stats = [(2, D("3.00"), D("1.50"), D("0.50"), D("1.00"), D("2.00"), "L1", 1, 1),
             (1, D("2.00"), D("2.00"), D("0.00"), D("2.00"), D("2.00"), "L2", 1, 2),
             (None, None, None, None, None, None, "L3", 1, 3)]      # zone without pixels
    nuts, lau, st = frames(spark, stats)
    l3 = {r.nuts_id: r for r in H.nuts3_rollup(H.attach_parent(st, lau), nuts).collect()}
    assert l3["AAB01"]["count"] == 3 and l3["AAB01"]["sum"] == D("5.00")
    assert l3["AAB01"]["mean"] == D("1.67")          # 5/3 rounded half up
    assert l3["AAB02"]["count"] is None and l3["AAB02"]["mean"] is None
    up = H.nuts_upper_rollup(H.nuts3_rollup(H.attach_parent(st, lau), nuts), nuts).collect()
    by = {(r.nuts_id, r.stat_levl_): r for r in up}
    assert set(by) == {("AA", 0), ("AAB", 1), ("AAB0", 2)}    # 2010 vintage excluded
    assert all(r["count"] == 3 and r["sum"] == D("5.00") for r in up)   # NULL-count child filtered


def test_per_child_grain_and_level_sums(spark):
    stats = [(2, D("3.00"), D("1.50"), D("0.50"), D("1.00"), D("2.00"), "L1", 1, 1),
             (4, D("10.00"), D("2.50"), D("0.50"), D("2.00"), D("3.00"), "L3", 1, 3),
             (1, D("1.00"), D("1.00"), D("0.00"), D("1.00"), D("1.00"), "L2", 1, 2)]
    nuts, lau, st = frames(spark, stats)
    l3 = H.nuts3_rollup(H.attach_parent(st, lau), nuts)
    per = H.nuts_upper_rollup(l3, nuts, per_child=True).collect()
    assert len(per) == 3 * 2                              # one row per (ancestor, child)
    assert {r.fk_nuts_gid for r in per} == {10000, 10001}
    full = H.rollup_all(st, lau, nuts).collect()
    lvl = {}
    for r in full:
        lvl.setdefault(r.stat_levl_, D(0))
        lvl[r.stat_levl_] += r["sum"]
    assert lvl[0] == lvl[3] == D("14.00")


def test_upper_rollup_matches_spark_rollup(spark):
    stats = [(2, D("3.00"), D("1.50"), D("0.50"), D("1.00"), D("2.00"), "L1", 1, 1),
             (4, D("10.00"), D("2.50"), D("0.50"), D("2.00"), D("3.00"), "L3", 1, 3)]
    nuts, lau, st = frames(spark, stats)
    l3 = H.nuts3_rollup(H.attach_parent(st, lau), nuts)
    split = l3.select(F.substring("nuts_id", 1, 2).alias("l0"), F.substring("nuts_id", 1, 3).alias("l1"),
                      F.substring("nuts_id", 1, 4).alias("l2"), "sum")
    ru = {tuple(r[:3]): r[3] for r in split.rollup("l0", "l1", "l2").agg(F.sum("sum")).collect()}
    mine = {r.nuts_id: r["sum"] for r in H.nuts_upper_rollup(l3, nuts).collect()}
    assert mine["AA"] == ru[("AA", None, None)] and mine["AAB0"] == ru[("AA", "AAB", "AAB0")]


def test_prefix_join_is_an_equi_join(spark):
    nuts, lau, st = frames(spark, [(1, D("1.00"), D("1.00"), D("0"), D("1"), D("1"), "L1", 1, 1)])
    df = H.nuts_upper_rollup(H.nuts3_rollup(H.attach_parent(st, lau), nuts), nuts)
    df.collect()
    p = plan_text(df)
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p
