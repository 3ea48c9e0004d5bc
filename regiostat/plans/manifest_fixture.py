"""B.9 manifests and the file listing, derived from ``part``.

The JSON text is built by one SQL expression that both Spark and DuckDB
evaluate unchanged (``||``, ``CASE``, ``rpad``, ``substr``), so the oracle
parses exactly the same text.  Defects follow from the part key:
% 7 no name, % 11 name of 60 characters, % 13 name ending ``.csv``,
% 17 no epsg, % 19 geometry type ``blob``, % 23 field without unit,
% 29 unknown spatial key field, % 31 no spatial reference, % 37 cut-off JSON;
% 41 declared files absent from the listing, % 47 no ``datapackage.json``.
Valid but unusual: % 43 contributors that are texts, % 53 ``doubleQuote`` as
text, % 59 ``temporal`` as text, % 61 ``"unit": null``, % 67 a name ending
``.CSV`` (the suffix test goes by case).
"""

from __future__ import annotations

K = "CAST(p_partkey AS STRING)"


def _res(i: int) -> str:
    nm = (f"CASE WHEN p_partkey % 11 = 0 THEN rpad('res_' || {K} || '_{i}_', 60, 'x') "
          f"ELSE 'res_' || {K} || '_{i}' END || CASE WHEN p_partkey % 13 = 0 THEN '.csv' WHEN p_partkey % 67 = 0 THEN '.CSV' ELSE '' END")
    ext = "CASE p_partkey % 4 WHEN 0 THEN 'shp' WHEN 1 THEN 'tif' WHEN 2 THEN 'csv' ELSE 'dat' END"
    vector = ("'\"vector\": {' || CASE WHEN p_partkey % 17 = 0 THEN '' ELSE '\"epsg\": \"3035\", ' END "
              "|| '\"geometry_type\": \"' || CASE WHEN p_partkey % 19 = 0 THEN 'blob' ELSE 'Polygon' END "
              "|| '\", \"schema\": [{\"name\": \"a\", ' || CASE WHEN p_partkey % 23 = 0 THEN '' "
              "ELSE '\"unit\": \"m\", ' END || '\"type\": \"integer\"}, {\"name\": \"b\", \"unit\": \"\", "
              "\"type\": \"string\"}]}'")
    raster = "'\"raster\": {' || CASE WHEN p_partkey % 17 = 0 THEN '' ELSE '\"epsg\": \"3035\"' END || '}'"
    tabular = ("'\"encoding\": \"utf-8\", \"dialect\": {\"delimiter\": \",\", \"doubleQuote\": ' || CASE WHEN p_partkey % 53 = 0 THEN '\"true\"' ELSE 'true' END || '}, "
               "\"schema\": {\"fields\": [{\"name\": \"nuts_id\", \"unit\": \"\", \"type\": \"string\"}, "
               "{\"name\": \"value\", ' || CASE WHEN p_partkey % 23 = 0 THEN '' ELSE '\"unit\": \"EUR\", ' END "
               "|| '\"type\": \"number\"}' || CASE WHEN p_partkey % 3 = 2 THEN ', {\"name\": \"geom\", "
               "\"unit\": \"\", \"type\": \"geometry\"}' ELSE '' END || ']}' "
               "|| CASE WHEN p_partkey % 31 = 0 THEN '' ELSE ', \"spatial_resolution\": \"NUTS 3\", "
               "\"spatial_key_field\": \"' || CASE WHEN p_partkey % 29 = 0 THEN 'nuts_code' ELSE 'nuts_id' END "
               "|| '\"' END || CASE WHEN p_partkey % 59 = 0 THEN ', \"temporal\": \"2015\"' WHEN p_partkey % 3 = 0 THEN '' ELSE ', \"temporal\": {\"start\": "
               "\"2015-01-01\", \"end\": \"2015-12-31\"}' END || CASE WHEN p_partkey % 5 = 0 THEN '' "
               "ELSE ', \"temporal_resolution\": \"year\"' END")
    body = f"CASE p_partkey % 4 WHEN 0 THEN {vector} WHEN 1 THEN {raster} WHEN 2 THEN {tabular} ELSE '\"extra\": \"x\"' END"
    return (f"'{{' || CASE WHEN p_partkey % 7 = 0 THEN '' ELSE '\"name\": \"' || {nm} || '\", ' END "
            f"|| '\"path\": \"data/res_' || {K} || '_{i}.' || {ext} || '\", \"format\": \"' || {ext} "
            f"|| '\", \"unit\": ' || CASE WHEN p_partkey % 61 = 0 THEN 'null' ELSE '\"MWh\"' END || ', ' || {body} || '}}'")


_PROFILE = ("CASE p_partkey % 4 WHEN 0 THEN 'vector-data-resource' WHEN 1 THEN 'raster-data-resource' "
            "WHEN 2 THEN 'tabular-data-resource' ELSE 'unsupported-resource' END")
_FULL = (f"'{{\"profile\": \"' || {_PROFILE} || '\", \"name\": \"pkg' || {K} || '\", \"version\": \"1.0\", "
         f"\"contributors\": [' || CASE WHEN p_partkey % 43 = 0 THEN '\"me\"' ELSE '{{\"title\": \"team' || CAST(p_partkey % 5 AS STRING) || '\"}}' END "
         f"|| '], \"resources\": [' "
         f"|| {_res(0)} || CASE WHEN p_partkey % 2 = 1 THEN ', ' || {_res(1)} ELSE '' END || ']}}'")

# the manifest text of one part row (same SQL in Spark and DuckDB)
MANIFEST_JSON_SQL = (f"CASE WHEN p_partkey % 37 = 0 THEN substr({_FULL}, 1, length({_FULL}) - 10) "
                     f"ELSE {_FULL} END")
PACKAGE_SQL = f"'pkg' || {K}"


def _keys(spark, sf, rows=10_000):
    """The part keys, dealt by their number: a key of a few bytes becomes a
    manifest of about a KB, which is then parsed."""
    from regiostat.plans.fixtures import Fixtures
    from regiostat.session import spread
    return spread(Fixtures(spark, sf).t("part").select("p_partkey"), rows)


def manifest_texts(spark, sf):
    from pyspark.sql import functions as F

    return _keys(spark, sf).select(F.expr(PACKAGE_SQL).alias("package"), F.expr(MANIFEST_JSON_SQL).alias("json"))


def file_listing(spark, sf):
    """Existing files ``package/path``: every declared resource file except
    for keys % 41, and ``datapackage.json`` except for keys % 47.  Paths are made
    quickly, so a task takes the keys of ten tasks of manifests."""
    from pyspark.sql import functions as F

    key = F.col("p_partkey")
    ext = F.expr("CASE p_partkey % 4 WHEN 0 THEN 'shp' WHEN 1 THEN 'tif' WHEN 2 THEN 'csv' ELSE 'dat' END")
    pkg = F.concat(F.lit("pkg"), key.cast("string"))
    res = F.transform(F.sequence(F.lit(0).cast("bigint"), key % 2), lambda i: F.concat(
        pkg, F.lit("/data/res_"), key.cast("string"), F.lit("_"), i.cast("string"), F.lit("."), ext))
    none = F.array().cast("array<string>")
    files = F.concat(F.when(key % 41 != 0, res).otherwise(none),
                     F.when(key % 47 != 0, F.array(F.concat(pkg, F.lit("/datapackage.json")))).otherwise(none))
    return _keys(spark, sf, 100_000).select(F.explode(files).alias("path"))


LISTING_SQL = """
SELECT 'pkg' || CAST(p_partkey AS VARCHAR) || '/data/res_' || CAST(p_partkey AS VARCHAR) || '_'
  || CAST(i AS VARCHAR) || '.' || CASE p_partkey % 4 WHEN 0 THEN 'shp' WHEN 1 THEN 'tif' WHEN 2 THEN 'csv'
  ELSE 'dat' END AS path
FROM (SELECT p_partkey, unnest(range(p_partkey % 2 + 1)) AS i FROM part WHERE p_partkey % 41 <> 0)
UNION ALL SELECT 'pkg' || CAST(p_partkey AS VARCHAR) || '/datapackage.json' FROM part WHERE p_partkey % 47 <> 0"""
