import datetime as dt

from pyspark.sql import functions as F

from regiostat.functions import geometry as G
from regiostat.functions import timefuncs as TF


def one(spark, col, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(col).first()[0]


def test_wkt_roundtrip_and_types(spark):
    cases = {
        "POLYGON ((0 0,4 0,4 4,0 0),(1 1,2 1,2 2,1 1))": ("POLYGON", 1, 2),
        "MULTIPOLYGON (((0 0,1 0,1 1,0 0)),((5 5,6 5,6 6,5 5),(5.25 5.5,5.5 5.5,5.5 5.75,5.25 5.5)))": ("MULTIPOLYGON", 2, 2),
        "POINT (1.5 2.5)": ("POINT", 1, 1),
        "LINESTRING (0 0,1 1,2 0)": ("LINESTRING", 1, 1),
        "MULTILINESTRING ((0 0,1 1),(2 2,3 3))": ("MULTILINESTRING", 2, 1),
    }
    for wkt, (t, nparts, nrings_last) in cases.items():
        g = one(spark, G.wkt_parse(F.col("v")).alias("g"), wkt)
        assert g.type == t and len(g.parts) == nparts and len(g.parts[-1]) == nrings_last
        assert one(spark, G.wkt_format(G.wkt_parse(F.col("v"))), wkt) == wkt


def test_ewkt_and_force_multi(spark):
    g = one(spark, G.ewkt_parse(F.col("v")).alias("g"), "SRID=3035;POLYGON((0 0, 1 0, 1 1, 0 0))")
    assert g.srid == 3035 and g.type == "POLYGON"
    m = one(spark, G.force_multi(G.ewkt_parse(F.col("v"))), "SRID=3035;POLYGON((0 0, 1 0, 1 1, 0 0))")
    assert m.type == "MULTIPOLYGON"


def test_laea_published_point(spark):
    df = spark.createDataFrame([(5.0, 50.0)], "lon double, lat double")
    e, n = G.laea_project("lon", "lat")
    r = df.select(e, n).first()
    assert abs(r[0] - 3962799.451) < 1e-3 and abs(r[1] - 2999718.853) < 1e-3


def test_parse_date_multi(spark):
    cases = {
        "2015/3/4 5:06:07": dt.datetime(2015, 3, 4, 5, 6, 7), "2015-03-04 05:06": dt.datetime(2015, 3, 4, 5, 6),
        "04/03/2015": dt.datetime(2015, 3, 4), "4.3.2015 10:00": dt.datetime(2015, 3, 4, 10, 0),
        "2015/03": dt.datetime(2015, 3, 1), "03/2015": dt.datetime(2015, 3, 1), "3.2015": dt.datetime(2015, 3, 1),
        "2015": dt.datetime(2015, 1, 1), "31/02/2015": None, "2015-01-01 24:00:00": None,
        "2015-01-01 ": None, "abc": None, "": None,
    }
    for text, want in cases.items():
        assert one(spark, TF.parse_date_multi(F.col("v")), text) == want, text


def test_time_attributes(spark):
    def attrs(ts):
        df = spark.createDataFrame([(ts,)], "t timestamp_ntz")
        return df.select(*TF.time_attributes("t"), TF.hour_of_year_compat("t").alias("hoy_c"),
                         TF.weekday_class_compat("t").alias("wd_c")).first()
    a = attrs(dt.datetime(2015, 3, 21, 0, 0))          # Saturday, first day of spring, midnight
    assert (a.weekday, a.season, a.hour_of_year, a.hoy_c, a.wd_c) == ("Sat", "spring", 79 * 24, 0, "Week")
    b = attrs(dt.datetime(2015, 12, 21, 5, 0))         # Monday, winter again
    assert (b.weekday, b.season) == ("Week", "winter")
    c = attrs(dt.datetime(2015, 9, 22, 1, 0))
    assert c.season == "summer"


def test_granularity(spark):
    for text, want in {"Yearly": "year", "MONTH": "month", "hourly": "hour", "decade": "", "Weeks": "week"}.items():
        assert one(spark, TF.normalize_granularity(F.col("v")), text) == want


def test_epoch_is_utc_whatever_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert one(spark, TF.epoch_to_timestamp(F.col("v")), "86400") == dt.datetime(1970, 1, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_transform_geometry_to_laea(spark):
    g = one(spark, G.transform_to_laea(G.wkt_parse(F.col("v"), 4326)), "POINT (5 50)")
    p = g.parts[0][0][0]
    assert g.srid == 3035 and abs(p.x - 3962799.451) < 1e-3 and abs(p.y - 2999718.853) < 1e-3
    same = one(spark, G.transform_to_laea(G.wkt_parse(F.col("v"), 3035)), "POINT (1 2)")
    assert same.parts[0][0][0].x == 1.0
