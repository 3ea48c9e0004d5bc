import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from regiostat.operators import dims as D
from regiostat.operators import tabular as TB
from regiostat.sources.csv import read_csv_dataset


def test_time_dim_upsert_is_idempotent(spark):
    keys = spark.createDataFrame([(dt.datetime(2015, 1, 1), "year"), (dt.datetime(2016, 1, 1), "year"),
                                  (dt.datetime(2015, 1, 1), "year")], "timestamp timestamp_ntz, granularity string")
    d1 = D.time_dim_upsert(D.empty_time_dim(spark), keys)
    d2 = D.time_dim_upsert(d1, keys)
    assert d1.count() == 2 and sorted(r.id for r in d2.collect()) == [1, 2]
    more = spark.createDataFrame([(dt.datetime(2014, 1, 1), "month")], "timestamp timestamp_ntz, granularity string")
    d3 = D.time_dim_upsert(d2, more)
    assert sorted(r.id for r in d3.collect()) == [1, 2, 3]


def test_dense_id_matches_row_number(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5003).alias("k"))
    big = D.dense_id(df, ["k"], start=10)
    ref = df.withColumn("id", F.row_number().over(Window.orderBy("k")) + 9)
    assert sorted(tuple(r) for r in big.collect()) == sorted(tuple(r) for r in ref.collect())


def test_registry_upsert(spark):
    reg = spark.createDataFrame([(1, "a", 10, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1))],
                                "id long, name string, git_id long, created timestamp_ntz, updated timestamp_ntz")
    touched = spark.createDataFrame([("a", 10), ("b", 11)], "name string, git_id long")
    out = {r.name: r for r in D.registry_upsert(reg, touched, "2024-01-01 00:00:00").collect()}
    assert out["a"].created == dt.datetime(2020, 1, 1) and out["a"].updated == dt.datetime(2024, 1, 1)
    assert out["b"].id == 2 and out["b"].created == dt.datetime(2024, 1, 1)


def test_like_join_wildcards(spark):
    regions = spark.createDataFrame([(5, "AB1"), (6, "AB2"), (7, "AC1")], "gid long, nuts_id string")
    fact = spark.createDataFrame([("ab%",), ("a_1",), ("ab2",), ("zz",)], "k string")
    got = {r.k: r.fk_nuts_gid for r in D.region_key_like_join(fact, "k", regions, vintage=None).collect()}
    assert got == {"ab%": 5, "a_1": 5, "ab2": 6}


def test_schema_plan_names_units_and_skips():
    plan = TB.schema_plan([TB.FieldSpec("Value EUR/m2", "number", "EUR"), TB.FieldSpec("Value-EUR-m2", "Number", "EUR"),
                           TB.FieldSpec("flag", "boolean", "x"), TB.FieldSpec("c", "text", "")])
    assert [c.column for c in plan.columns] == ["value_eur_m2", "value_eur_m2_1", "flag"]
    assert [c.unit for c in plan.columns] == ["EUR", "EUR", None]
    assert plan.skipped == [("c", "text")]


def test_reject_rows_and_booleans(spark):
    plan = TB.schema_plan([TB.FieldSpec("n", "integer"), TB.FieldSpec("b", "boolean"), TB.FieldSpec("v", "number")])
    raw = spark.createDataFrame([("1", "on", "2.345"), ("3.0", "t", ""), ("2", "tru", "n/a")], "n string, b string, v string")
    acc, rej = TB.reject_rows(TB.typed_projection(raw, plan), plan)
    assert [tuple(r) for r in acc.collect()] == [(1, True, Decimal("2.35"))]
    assert rej.count() == 2


def test_csv_dialects(spark, tmp_path):
    p1 = os.path.join(tmp_path, "a.csv")
    with open(p1, "wb") as f:
        f.write('﻿name;note\n"x";"say ""hi""\nthere"\n'.encode("utf-8"))
    from regiostat.sources.csv import has_broken_lines
    assert has_broken_lines(spark, p1)
    r = read_csv_dataset(spark, p1, delimiter=";", encoding="utf8", multi_line=True).collect()
    assert r[0]["name"] == "x" and r[0]["note"] == 'say "hi"\nthere'
    p2 = os.path.join(tmp_path, "b.csv")
    with open(p2, "wb") as f:
        f.write("name,city\nA,Zürich\n".encode("iso-8859-1"))
    assert not has_broken_lines(spark, p2, "latin-1")
    for name in ("ISO-8859-1", "latin-1", "cp1252"):
        assert read_csv_dataset(spark, p2, encoding=name).collect()[0]["city"] == "Zürich"
    p3 = os.path.join(tmp_path, "c.csv")
    with open(p3, "wb") as f:
        f.write("name,preis\nA,5 \u20ac\n".encode("cp1252"))
    assert read_csv_dataset(spark, p3, encoding="cp1252").collect()[0]["preis"] == "5 \u20ac"
