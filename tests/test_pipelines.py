import json
import os

from pyspark.sql import functions as F

from regiostat.plans import pipelines as P


def test_validate_and_integrate_package(spark, tmp_path):
    root = str(tmp_path / "repos")
    pkg = os.path.join(root, "heat_density")
    os.makedirs(os.path.join(pkg, "data"))
    with open(os.path.join(pkg, "data", "hd.csv"), "w") as f:
        f.write("nuts_id;value;datetime\naa1;1,5;2015/01/01\nzz9;2;2015/01/01\naa1;3;2016-01-01 00:00\n")
    res = {"name": "hd", "path": "data/hd.csv", "format": "csv", "encoding": "utf-8",
           "dialect": {"delimiter": ";", "doubleQuote": True},
           "schema": {"fields": [{"name": "nuts_id", "unit": "", "type": "string"},
                                 {"name": "value", "unit": "MWh", "type": "string"},
                                 {"name": "datetime", "unit": "", "type": "datetime"}]},
           "spatial_resolution": "NUTS 3", "spatial_key_field": "nuts_id", "temporal_resolution": "year"}
    with open(os.path.join(pkg, "datapackage.json"), "w") as f:
        json.dump({"profile": "tabular-data-resource", "name": "heat_density", "resources": [res]}, f)
    os.makedirs(os.path.join(root, "broken"))
    with open(os.path.join(root, "broken", "datapackage.json"), "w") as f:
        f.write('{"profile": ')
    v = P.validate_packages(spark, root)
    gate = {r.package: r.decision for r in v.gate.collect()}
    assert gate == {"heat_density": "load", "broken": "skip"}
    todo = P.accepted_tabular_resources(v)
    assert [p for p, _ in todo] == ["heat_density"]
    nuts = spark.createDataFrame([(7, "AA1", 3, "2013-01-01")], "gid long, nuts_id string, stat_levl_ int, year string") \
        .withColumn("year", F.col("year").cast("date"))
    out = P.integrate_tabular(spark, pkg, todo[0][1], nuts, None, None, str(tmp_path / "out"))
    rows = sorted(spark.read.parquet(str(tmp_path / "out" / "fact")).collect(), key=lambda r: r.id)
    assert [(r.nuts_id, r.fk_nuts_gid, r.fk_time_id) for r in rows] == [("aa1", 7, 1), ("aa1", 7, 2)]
    assert out.unmatched.collect()[0]["key"] == "zz9"
