"""Steps of the manifest queries: values read together, a listing that is
merged with short columns only, rules that run once before the sort."""

from pyspark.sql import functions as F

from core_helpers import plan_text
from regiostat.operators import validate as V
from regiostat.plans import q_validate as Q
from regiostat.plans.manifest_fixture import file_listing
from regiostat.sources import manifest as M

DOCS = [
    ("a", '{"profile": "vector-data-resource", "resources": [{"name": "n", "path": "data/x.shp", "unit": null, "vector": {"epsg": 3035, '
          '"schema": [{"name": "f", "unit": "", "type": "t"}, "text"]}, "temporal": "2015", "dialect": {"doubleQuote": "TRUE"}}]}'),
    ("b", '{"profile": "raster-data-resource", "contributors": [{"title": "T"}, {}], "resources": [{"path": "data/y.tif", "raster": []}, 7, {"path": null}]}'),
    ("c", '{"profile": "tabular-data-resource", "resources": [{"path": "data/z.csv", "schema": {"fields": [{"name": "v", "unit": "m", "type": "geometry"}]}}]}'),
    ("d", "{"),
]


def scanned(spark):
    return M.manifest_scan(spark.createDataFrame(DOCS, "package string, json string"))


def test_resources_are_read_by_a_few_casts(spark):
    assert 0 < str(M.parse_manifest("json")).count("variant_get(") <= 10
    rows = {r.package: r for r in scanned(spark).collect()}
    r = rows["a"].m.resources[0]
    assert (r.vector.epsg, r.unit, r.dialect.doubleQuote) == ("3035", None, True) and "unit" in r["keys"] and r.schema is None
    assert r.temporal is not None and r.temporal.start is None  # there, but no object
    assert [f.name for f in r.vector.schema] == ["f", None] and r.vector_complete is False and r.vector_keys == ["epsg", "schema"]
    y, seven, nothing = rows["b"].m.resources
    assert y.raster is not None and y.raster_keys == [] and seven.path is None and seven["keys"] == [] and nothing["keys"] == ["path"]
    assert [c.title for c in rows["b"].m.contributors] == ["T"] and rows["c"].m.resources[0].fields_complete is True and rows["d"].corrupt


def test_listing_meets_short_columns_without_broadcast(spark):
    listing = spark.createDataFrame([("a/data/other.shp",), ("a/data/other.shp",), (None,), ("b/datapackage.json",)], "path string")
    res = M.manifest_resources(scanned(spark))
    v = V.resource_violations(res, listing).filter("rule = 'v_path'")
    plan = plan_text(V.without_file(res, listing))
    assert "LeftAnti" in plan and "Broadcast" not in plan
    assert sorted((r.package, r.ridx, r.ord, r.kind, r.message) for r in v.collect()) == [("a", 0, 100, "error", V.MSG_PATH), ("b", 0, 100, "error", V.MSG_PATH)]
    found = listing.union(spark.createDataFrame([("b/data/y.tif",)], "path string"))
    assert [r.package for r in V.resource_violations(res, found).filter("rule = 'v_path'").collect()] == ["a"]
    assert V.resource_violations(res, None).filter("rule = 'v_path'").count() == 0
    # another rule alone does not ask for the files
    assert "Join" not in plan_text(V.resource_violations(res, listing).filter("rule = 'v_epsg'"))
    assert sorted(map(tuple, V.missing_paths(res, listing).collect())) == [
        ("a/data/x.shp", "a", 0), ("b/data/y.tif", "b", 0), ("c/data/z.csv", "c", 0)]


def test_listing_in_few_tasks(spark, tmp_path):
    keys = [None, -82, -1, 0, 1, 2, 3, 41, 47, 94, *range(1000, 36000)]
    spark.createDataFrame([(k,) for k in keys], "p_partkey long").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    got = file_listing(spark, str(tmp_path))
    assert got.rdd.getNumPartitions() == 1
    small = {r.path for r in got.filter(~F.col("path").rlike(r"^pkg\d{4,}/")).collect()}
    assert small == {"pkg-82/datapackage.json", "pkg-1/data/res_-1_0.dat", "pkg-1/data/res_-1_-1.dat", "pkg-1/datapackage.json",
                     "pkg1/data/res_1_0.tif", "pkg1/data/res_1_1.tif", "pkg1/datapackage.json", "pkg2/data/res_2_0.csv", "pkg2/datapackage.json",
                     "pkg3/data/res_3_0.dat", "pkg3/data/res_3_1.dat", "pkg3/datapackage.json", "pkg41/datapackage.json",
                     "pkg47/data/res_47_0.dat", "pkg47/data/res_47_1.dat", "pkg94/data/res_94_0.csv"}
    want = sum((k % 41 != 0) * (1 + k % 2) + (k % 47 != 0) for k in range(1000, 36000))
    assert got.count() == len(small) + want


def test_rules_run_once_before_the_sort(spark, tmp_path):
    spark.createDataFrame([(k,) for k in range(200)], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    got = Q.q_sorted_errors(spark, str(tmp_path))
    assert "Generate" not in plan_text(got) and "Sort" in plan_text(got)
    want = [tuple(r) for r in Q.q_v_schema_violations(spark, str(tmp_path)).select("package", "message").collect()]
    assert [tuple(r) for r in got.collect()] == sorted(want)
