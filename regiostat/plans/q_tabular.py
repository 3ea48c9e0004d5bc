"""Time functions, dimension maintenance and tabular ingest queries (stage 3)."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from regiostat.functions import text as TX
from regiostat.functions import timefuncs as TF
from regiostat.operators import dims as D
from regiostat.operators import tabular as TB
from regiostat.plans.fixture_sql import cte, duck_parse, with_ctes
from regiostat.plans.fixtures import TABULAR_RESOLUTION, TABULAR_START, Fixtures, tabular_fields
from regiostat.plans.registry import register
from regiostat.session import materialize, staging_path
from regiostat.sources.csv import read_csv_dataset, write_csv_dataset

PARSED = duck_parse("ts_text")


def _parsed(spark, sf):
    return Fixtures(spark, sf).time_text().select("o_orderkey", "ts_text", "gran_text",
                                                 TF.parse_date_multi("ts_text").alias("ts"))


cte("parsed", ["time_text"], f"SELECT o_orderkey, ts_text, gran_text, {PARSED} AS ts FROM time_text")


@register("parse_date_multi", with_ctes(["parsed"], "SELECT o_orderkey, ts_text, ts FROM parsed"))
def q_parse_date_multi(spark, sf):
    return _parsed(spark, sf).select("o_orderkey", "ts_text", "ts")


SEASON_SQL = """CASE WHEN month(ts) * 100 + day(ts) <= 320 THEN 'winter' WHEN month(ts) * 100 + day(ts) <= 620
 THEN 'spring' WHEN month(ts) * 100 + day(ts) <= 922 THEN 'summer' WHEN month(ts) * 100 + day(ts) <= 1220
 THEN 'autumn' ELSE 'winter' END"""
WEEKDAY_SQL = "CASE WHEN dayofweek(ts) IN (0, 6) THEN strftime(ts, '%a') ELSE 'Week' END"
HOY_SQL = "CAST((dayofyear(ts) - 1) * 24 + hour(ts) AS INTEGER)"
ATTR_SQL = f"""CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
  {WEEKDAY_SQL} AS weekday, {SEASON_SQL} AS season, CAST(hour(ts) AS INTEGER) AS hour_of_day,
  {HOY_SQL} AS hour_of_year, CAST(ts AS DATE) AS date"""


@register("time_attributes", with_ctes(["parsed"], f"SELECT o_orderkey, {ATTR_SQL} FROM parsed WHERE ts IS NOT NULL"))
def q_time_attributes(spark, sf):
    p = _parsed(spark, sf).filter(F.col("ts").isNotNull())
    return p.select("o_orderkey", *TF.time_attributes("ts"))


def _one(name, sql_expr, fn):
    register(name, with_ctes(["parsed"], f"SELECT o_orderkey, {sql_expr} AS v FROM parsed WHERE ts IS NOT NULL"))(
        lambda spark, sf: _parsed(spark, sf).filter(F.col("ts").isNotNull()).select("o_orderkey", fn("ts").alias("v")))


_one("weekday_class", WEEKDAY_SQL, TF.weekday_class)
_one("weekday_class_compat", "'Week'", TF.weekday_class_compat)
_one("season", SEASON_SQL, TF.season)
_one("hour_of_year", HOY_SQL, TF.hour_of_year)
_one("hour_of_year_compat", "CAST(dayofyear(ts) * hour(ts) AS INTEGER)", TF.hour_of_year_compat)
_one("normalize_timestamp", "strftime(ts, '%Y/%m/%d %H:%M:%S')", TF.normalize_timestamp)

GRAN_SQL = ("CASE " + " ".join(f"WHEN starts_with(lower(gran_text), '{g}') THEN '{g}'" for g in TF.GRANULARITIES)
            + " ELSE '' END")


@register("normalize_granularity", with_ctes(["time_text"], f"SELECT o_orderkey, {GRAN_SQL} AS granularity "
                                                           "FROM time_text"))
def q_normalize_granularity(spark, sf):
    t = Fixtures(spark, sf).time_text()
    return t.select("o_orderkey", TF.normalize_granularity("gran_text").alias("granularity"))


@register("epoch_to_timestamp", "SELECT event_id, date_trunc('second', ts) AS ts2 FROM events")
def q_epoch_to_timestamp(spark, sf):
    e = Fixtures(spark, sf).t("events")
    epoch = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    return e.select("event_id", TF.epoch_to_timestamp(epoch.cast("string")).alias("ts2"))


@register("row_time_source", with_ctes(["parsed"], f"""
SELECT o_orderkey, COALESCE(CASE WHEN o_orderkey % 2 = 0 THEN ts END,
  CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '1970-01-01 00:00:00' + to_seconds(o_orderkey * 3600) END,
  TIMESTAMP '{TABULAR_START}') AS row_ts FROM parsed"""))
def q_row_time_source(spark, sf):
    """a datetime column, else epoch seconds, else the manifest's start."""
    k = F.col("o_orderkey")
    p = _parsed(spark, sf).select("o_orderkey", F.when(k % 2 == 0, F.col("ts")).alias("datetime"),
                                  F.when(k % 3 == 0, (k * 3600).cast("string")).alias("_epoch_timestamp"))
    plan = TB.schema_plan([TB.FieldSpec("datetime", "datetime"), TB.FieldSpec("timestamp", "timestamp")])
    return p.select("o_orderkey", TB.row_time(p, plan, TABULAR_START).alias("row_ts"))


# -- time dimension ---------------------------------------------------------------------
cte("tkeys", ["parsed"], f"SELECT o_orderkey, ts AS timestamp, {GRAN_SQL} AS granularity FROM parsed "
                         "WHERE ts IS NOT NULL")
cte("tdim_old", ["tkeys"], """
SELECT row_number() OVER (ORDER BY timestamp, granularity) AS id, timestamp, granularity
FROM (SELECT DISTINCT timestamp, granularity FROM tkeys WHERE o_orderkey % 3 = 0)""")
cte("tdim", ["tkeys", "tdim_old"], """
SELECT * FROM tdim_old UNION ALL
SELECT (SELECT max(id) FROM tdim_old) + row_number() OVER (ORDER BY timestamp, granularity), timestamp, granularity
FROM (SELECT DISTINCT timestamp, granularity FROM tkeys
      EXCEPT SELECT timestamp, granularity FROM tdim_old)""")


def _time_keys(spark, sf):
    p = _parsed(spark, sf).filter(F.col("ts").isNotNull())
    return p.select("o_orderkey", F.col("ts").alias("timestamp"),
                    TF.normalize_granularity("gran_text").alias("granularity"))


def _time_dim(spark, sf):
    k = materialize(_time_keys(spark, sf))          # the parsed source, stored once
    old = materialize(D.time_dim_upsert(None, k.filter(F.col("o_orderkey") % 3 == 0)))
    return k, D.time_dim_upsert(old, k)


@register("time_dim_upsert", with_ctes(["tdim"], f"""
SELECT id, timestamp, {ATTR_SQL.replace('(ts)', '(timestamp)').replace('ts AS DATE', 'timestamp AS DATE')
                       .replace("strftime(ts,", "strftime(timestamp,")}, granularity FROM tdim"""))
def q_time_dim_upsert(spark, sf):
    return _time_dim(spark, sf)[1]


@register("time_lookup", with_ctes(["tkeys", "tdim"], """
SELECT k.o_orderkey, d.id AS fk_time_id FROM tkeys k LEFT JOIN tdim d
  ON d.timestamp = k.timestamp AND d.granularity = k.granularity"""))
def q_time_lookup(spark, sf):
    k, dim = _time_dim(spark, sf)
    return D.time_lookup(k, dim).select("o_orderkey", "fk_time_id")


# -- region keys ----------------------------------------------------------------------------
NUTS_DIM = "(SELECT nuts_id, min(gid) AS gid FROM nuts WHERE year = DATE '2013-01-01' GROUP BY nuts_id)"


@register("region_key_join", with_ctes(["raw_tabular", "nuts"], f"""
SELECT r."key", n.gid AS fk_nuts_gid FROM raw_tabular r JOIN {NUTS_DIM} n ON upper(r."key") = n.nuts_id"""))
def q_region_key_join(spark, sf):
    fx = Fixtures(spark, sf)
    return D.region_key_join(fx.raw_tabular().select("key"), "key", fx.nuts())


cte("lau_keys", [], """
SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'c99999' ELSE 'c' || CAST(o_custkey AS VARCHAR) END AS k
FROM orders""")


def _lau_keys(fx):
    k = F.col("o_orderkey")
    return fx.t("orders").select("o_orderkey", F.when(k % 50 == 0, F.lit("c99999")).otherwise(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string"))).alias("k"))


@register("region_key_join_lau", with_ctes(["lau_keys", "lau"], """
SELECT o_orderkey, k, l.gid AS fk_lau_gid FROM lau_keys JOIN lau l ON upper(k) = l.comm_id"""))
def q_region_key_join_lau(spark, sf):
    fx = Fixtures(spark, sf)
    return D.region_key_join(_lau_keys(fx), "k", fx.lau(), "comm_id", None, "fk_lau_gid")


@register("unmatched_region_keys", with_ctes(["raw_tabular", "nuts"], f"""
SELECT r."key" AS "key", count(*) AS n_rows FROM raw_tabular r
WHERE upper(r."key") NOT IN (SELECT nuts_id FROM {NUTS_DIM}) OR r."key" IS NULL GROUP BY r."key" """))
def q_unmatched_region_keys(spark, sf):
    fx = Fixtures(spark, sf)
    return D.unmatched_region_keys(fx.raw_tabular().select("key"), "key", fx.nuts())


cte("like_keys", ["time_text", "lau"], """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN substr(l.nuts_id, 1, 4) || '%'
                        WHEN o_orderkey % 7 = 1 THEN substr(l.nuts_id, 1, 4) || '_'
                        ELSE lower(l.nuts_id) END AS k
FROM orders o JOIN lau l ON l.gid = o.o_custkey""")


@register("region_key_like_join", with_ctes(["like_keys", "nuts"], f"""
SELECT o_orderkey, k, min(n.gid) AS fk_nuts_gid FROM like_keys JOIN {NUTS_DIM} n ON n.nuts_id LIKE upper(k)
GROUP BY o_orderkey, k"""))
def q_region_key_like_join(spark, sf):
    fx = Fixtures(spark, sf)
    k = F.col("o_orderkey")
    lau = fx.lau().select(F.col("gid").alias("o_custkey"), "nuts_id")
    o = fx.t("orders").join(lau, "o_custkey")
    keys = o.select("o_orderkey", F.when(k % 7 == 0, F.concat(F.substring("nuts_id", 1, 4), F.lit("%")))
                    .when(k % 7 == 1, F.concat(F.substring("nuts_id", 1, 4), F.lit("_")))
                    .otherwise(F.lower("nuts_id")).alias("k"))
    return D.region_key_like_join(keys, "k", fx.nuts()).select("o_orderkey", "k", "fk_nuts_gid")


@register("upper_key", with_ctes(["raw_tabular"], 'SELECT upper("key") AS k FROM raw_tabular'))
def q_upper_key(spark, sf):
    return Fixtures(spark, sf).raw_tabular().select(TX.upper_key("key").alias("k"))


# -- names, typing, rejects ------------------------------------------------------------------
@register("sanitize_table_name", """
SELECT p_partkey, regexp_replace(replace(lower(CASE WHEN p_partkey % 3 = 0 THEN 'Quilldew_' || p_name
  ELSE p_name || ' ' || p_brand END), 'quilldew', ''), '[^A-Za-z0-9]+', '_', 'g') AS table_name FROM part""")
def q_sanitize_table_name(spark, sf):
    p = Fixtures(spark, sf).t("part")
    name = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("Quilldew_"), "p_name")).otherwise(
        F.concat_ws(" ", "p_name", "p_brand"))
    return p.select("p_partkey", TX.sanitize_name(name, token="quilldew").alias("table_name"))


PLAN = TB.schema_plan(tabular_fields())


@register("sanitize_columns", with_ctes(["raw_tabular"], """
SELECT "key" AS "key", "Value EUR/m2" AS value_eur_m2, "Value-EUR-m2" AS value_eur_m2_1, "count" AS "count",
  flag, datetime FROM raw_tabular"""))
def q_sanitize_columns(spark, sf):
    return TB.sanitize_columns(Fixtures(spark, sf).raw_tabular(), PLAN)


@register("empty_to_null", with_ctes(["raw_tabular"], """SELECT nullif("Value EUR/m2", '') AS v FROM raw_tabular"""))
def q_empty_to_null(spark, sf):
    return Fixtures(spark, sf).raw_tabular().select(TB.empty_to_null(F.col("`Value EUR/m2`")).alias("v"))


@register("typed_projection", with_ctes(["typed_tabular"], """
SELECT "key", value_eur_m2, value_eur_m2_1, "count", flag, datetime FROM typed_tabular"""))
def q_typed_projection(spark, sf):
    return TB.typed_projection(Fixtures(spark, sf).raw_tabular(), PLAN, keep_raw=False)


@register("reject_rows", with_ctes(["typed_tabular"], """
SELECT "key", r1 AS _raw_value_eur_m2, r2 AS _raw_value_eur_m2_1, r3 AS _raw_count, r4 AS _raw_flag,
  r5 AS _raw_datetime FROM typed_tabular
WHERE (r1 IS NOT NULL AND value_eur_m2 IS NULL) OR (r2 IS NOT NULL AND value_eur_m2_1 IS NULL)
   OR (r3 IS NOT NULL AND "count" IS NULL) OR (r4 IS NOT NULL AND flag IS NULL)
   OR (r5 IS NOT NULL AND datetime IS NULL) OR length("key") > 255"""))
def q_reject_rows(spark, sf):
    typed = TB.typed_projection(Fixtures(spark, sf).raw_tabular(), PLAN)
    _, rej = TB.reject_rows(typed, PLAN)
    return rej.select("key", *[f"_raw_{c}" for c in ["value_eur_m2", "value_eur_m2_1", "count", "flag",
                                                     "datetime"]])


@register("unit_columns", with_ctes(["accepted_tabular"], """
SELECT *, 'EUR' AS value_eur_m2_unit, 'EUR' AS value_eur_m2_1_unit FROM accepted_tabular"""))
def q_unit_columns(spark, sf):
    typed = TB.typed_projection(Fixtures(spark, sf).raw_tabular(), PLAN)
    acc, _ = TB.reject_rows(typed, PLAN)
    return TB.unit_columns(acc, PLAN)


@register("metadata_columns", with_ctes(["zvert"], f"""
SELECT DISTINCT gid, DATE '2013-01-01' AS date, TIMESTAMP '{TABULAR_START}' AS timestamp,
  CAST(1 AS BIGINT) AS fk_time_id FROM zvert"""))
def q_metadata_columns(spark, sf):
    z = Fixtures(spark, sf).zones().select("gid")
    keys = z.select(TF.parse_date_multi(F.lit(TABULAR_START)).alias("timestamp"),
                    TF.normalize_granularity(F.lit("year")).alias("granularity"))
    dim = D.time_dim_upsert(None, keys)
    return TB.metadata_columns(z, TABULAR_START, "year", dim)


@register("dense_id", """
SELECT row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS id, c_custkey, c_mktsegment FROM customer""")
def q_dense_id(spark, sf):
    c = Fixtures(spark, sf).t("customer").select("c_custkey", "c_mktsegment")
    return D.dense_id(c, ["c_mktsegment", "c_custkey"])


@register("first_match", with_ctes(["nuts"], """
SELECT n.nuts_id, n.gid, n.year FROM nuts n JOIN (SELECT nuts_id, min(gid) AS g FROM nuts GROUP BY nuts_id) m
  ON m.nuts_id = n.nuts_id AND m.g = n.gid"""))
def q_first_match(spark, sf):
    n = Fixtures(spark, sf).nuts().select("nuts_id", "gid", "year")
    return D.first_match(n, ["nuts_id"], "gid")


# -- CSV source and the whole tabular ingest ---------------------------------------------------
def staged_csv(spark, sf):
    """S3: the raw dataset written as ``;``-separated CSV with a header in the
    shared folder, read back as text columns."""
    path = staging_path(spark, "raw_tabular_csv")
    write_csv_dataset(Fixtures(spark, sf).raw_tabular(), path, delimiter=";")
    return read_csv_dataset(spark, path, delimiter=";", double_quote=True, encoding="utf-8")


@register("csv_tabular_scan", with_ctes(["raw_tabular"], """
SELECT "key", nullif("Value EUR/m2", '') AS v1, "Value-EUR-m2" AS v2, "count", flag, nullif(datetime, '') AS dt,
  comment FROM raw_tabular"""))
def q_csv_tabular_scan(spark, sf):
    r = staged_csv(spark, sf)
    return r.select("key", TB.empty_to_null(F.col("`Value EUR/m2`")).alias("v1"), F.col("`Value-EUR-m2`").alias("v2"),
                    "count", "flag", TB.empty_to_null(F.col("datetime")).alias("dt"), "comment")


INGEST_COLS = ['"key"', "value_eur_m2", "value_eur_m2_1", '"count"', "flag", "datetime", "fk_nuts_gid",
               "fk_time_id", "value_eur_m2_unit", "value_eur_m2_1_unit"]
cte("ingest_matched", ["accepted_tabular", "nuts"], f"""
SELECT a.*, n.gid AS fk_nuts_gid, COALESCE(a.datetime, TIMESTAMP '{TABULAR_START}') AS _ts, 'year' AS _gr
FROM accepted_tabular a JOIN {NUTS_DIM} n ON upper(a."key") = n.nuts_id""")
cte("ingest_tdim", ["ingest_matched"], """
SELECT row_number() OVER (ORDER BY _ts, _gr) AS id, _ts, _gr FROM (SELECT DISTINCT _ts, _gr FROM ingest_matched)""")
cte("ingest_fact", ["ingest_matched", "ingest_tdim"], """
SELECT m."key", m.value_eur_m2, m.value_eur_m2_1, m."count", m.flag, m.datetime, m.fk_nuts_gid,
  t.id AS fk_time_id, 'EUR' AS value_eur_m2_unit, 'EUR' AS value_eur_m2_1_unit
FROM ingest_matched m JOIN ingest_tdim t ON t._ts = m._ts AND t._gr = m._gr""")


@register("tabular_ingest", with_ctes(["ingest_fact"], """
SELECT *, (SELECT count(*) FROM ingest_fact) AS n_ids, CAST(1 AS BIGINT) AS first_id, (SELECT count(*) FROM ingest_fact) AS last_id FROM ingest_fact"""))
def q_tabular_ingest(spark, sf):
    """CSV -> typed -> rejects out -> region key -> time id -> units -> ids.
    The ids follow the storage order, so what is compared is that they are
    all different and without gaps."""
    fact = loaded_tabular(spark, sf)[0]
    n, first, last = fact.agg(F.countDistinct("id"), F.min("id"), F.max("id")).first()
    return fact.drop("id").withColumns({"n_ids": F.lit(n).cast("bigint"), "first_id": F.lit(first).cast("bigint"), "last_id": F.lit(last).cast("bigint")})


@register("tabular_ingest_strict", with_ctes(["typed_tabular", "accepted_tabular"], """
SELECT 'raw_tabular' AS dataset, (SELECT count(*) FROM typed_tabular) - (SELECT count(*) FROM accepted_tabular) AS n_messages, CAST(0 AS BIGINT) AS n_loaded"""))
def q_tabular_ingest_strict(spark, sf):
    """The default mode: a dataset with bad rows loads nothing and leaves an issue."""
    res = TB.ingest_tabular(staged_csv(spark, sf), tabular_fields(), Fixtures(spark, sf).nuts(), "NUTS 3", "key",
                            None, TABULAR_RESOLUTION, TABULAR_START, dataset="raw_tabular")
    return res.issues.select("dataset", "n_messages").withColumn("n_loaded", F.lit(res.fact.count()).cast("bigint"))


#: Tables that a caller has loaded beforehand, by folder (see ``keep_loaded``).
_KEPT: dict[str, tuple] = {}


def loaded_tabular(spark, sf):
    """(fact, time dimension) of the fixture dataset, loaded and stored now,
    unless the caller keeps a loaded one."""
    if sf in _KEPT:
        return _KEPT[sf]
    fx = Fixtures(spark, sf)
    res = TB.ingest_tabular(staged_csv(spark, sf), tabular_fields(), fx.nuts(), "NUTS 3", "key",
                            None, TABULAR_RESOLUTION, TABULAR_START, all_or_nothing=False)
    return res.fact, res.time_dim


@contextmanager
def keep_loaded(spark, sf):
    """Within the block, views read one stored fact table (loaded here) instead
    of loading it each."""
    fact, time_dim = loaded_tabular(spark, sf)
    _KEPT[sf] = (materialize(fact, "fact"), materialize(time_dim, "time"))
    try:
        yield
    finally:
        del _KEPT[sf]
