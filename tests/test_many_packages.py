"""Many manifests: tasks that grow with their rows, one pass for their issues."""

from pyspark.sql import functions as F

from regiostat import session
from regiostat.operators import validate as V
from regiostat.plans.manifest_fixture import file_listing, manifest_texts
from regiostat.sources import sinks as SK


def part_table(spark, folder, rows):
    spark.range(rows).select(F.col("id").alias("p_partkey")).coalesce(1).write.parquet(f"{folder}/part.parquet")
    return str(folder)


def test_manifests_are_dealt_by_rows(spark, tmp_path):
    sf = part_table(spark, tmp_path, 35_000)
    assert manifest_texts(spark, sf).rdd.getNumPartitions() == 4
    assert manifest_texts(spark, sf).count() == 35_000 and file_listing(spark, sf).select("path").distinct().count() == file_listing(spark, sf).count()
    assert session.spread(spark.range(0)).count() == 0


def test_issues_from_one_aggregation(spark):
    rows = [("p", 0, "v_name", 11, "error", "b"), ("p", 0, "v_name", 11, "error", "b"), ("p", None, "v_profile", 1, "missing", "a"), (None, None, "v_profile", 1, "missing", "a"), ("q", 1, "v_path", 100, "error", "c")]
    v = spark.createDataFrame(rows, "package string, ridx int, rule string, ord int, kind string, message string")
    m = spark.createDataFrame([("p", (["x"],))], "package string, m struct<c: array<string>>").select("package", F.struct(F.transform("m.c", lambda t: F.struct(t.alias("title"))).alias("contributors")).alias("m"))
    issues = SK.issue_rows(v, m)
    assert issues._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1
    assert {(r.dataset, r.n_messages, tuple(r.tags or ())) for r in issues.collect()} == {("p", 3, ("x",)), ("q", 1, ())}
    assert issues.schema["n_messages"].dataType.simpleString() == "bigint"
    assert V.validation_report(v).columns == ["package", "report"]
