"""Manifest validation queries (stage 5) over the B.9 manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiostat.functions import text as TX
from regiostat.operators import tabular as TB
from regiostat.operators import validate as V
from regiostat.plans.fixture_sql import cte, with_ctes
from regiostat.plans.manifest_fixture import LISTING_SQL, MANIFEST_JSON_SQL, PACKAGE_SQL, file_listing, manifest_texts
from regiostat.plans.registry import register
from regiostat.session import materialize
from regiostat.sources import manifest as M


def _manifests(spark, sf):
    return M.manifest_scan(manifest_texts(spark, sf))


def _resources(spark, sf):
    return M.manifest_resources(_manifests(spark, sf))


def _violations(spark, sf):
    """All rules over manifests that are parsed once and stored."""
    return _validated(spark, sf)[1]


def _validated(spark, sf):
    m = materialize(_manifests(spark, sf), "manifests")
    return m, V.all_violations(m, M.manifest_resources(m), file_listing(spark, sf))


# -- DuckDB twins ---------------------------------------------------------------------
cte("mf", [], f"SELECT {PACKAGE_SQL} AS package, {MANIFEST_JSON_SQL} AS json FROM part")
cte("mpkg", ["mf"], "SELECT package, json AS j FROM mf WHERE json_valid(json)")
cte("mres", ["mpkg"], """
SELECT package, json_extract_string(j, '$.profile') AS profile, CAST(i AS INTEGER) AS ridx,
       json_extract(j, '$.resources[' || CAST(i AS VARCHAR) || ']') AS r
FROM (SELECT package, j, unnest(range(CAST(json_array_length(j, '$.resources') AS BIGINT))) AS i FROM mpkg)""")
cte("listing", [], LISTING_SQL)
cte("mres_ex", ["mres", "listing"], """
SELECT m.*, (l.path IS NOT NULL) AS ex FROM mres m
LEFT JOIN (SELECT DISTINCT path FROM listing) l ON l.path = m.package || '/' || json_extract_string(m.r, '$.path')""")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _has(path: str) -> str:
    return f"json_exists(r, '{path}')"


def _incomplete_sql(path: str) -> str:
    return (f"COALESCE(list_bool_or([NOT (json_exists(e, '$.name') AND json_exists(e, '$.unit') AND "
            f"json_exists(e, '$.type')) FOR e IN json_extract(r, '{path}[*]')]), false)")


def _rule_sql():
    """(Rule, SQL condition) in the same order as the Spark rule table."""
    out = []
    for prof, props in V.PROPS.items():
        for i, p in enumerate(props):
            base = 10 * (i + 1)
            out.append((V.Rule(V.PROP_RULE[prof], base, "missing", f"resources/{p}", prof), f"NOT {_has('$.' + p)}"))
            if p == "name":
                out.append((V.Rule("v_name", base + 1, "error", V.MSG_NAME_LONG, prof),
                            "length(json_extract_string(r, '$.name')) > 50"))
                exts = "|".join(TX.BAD_EXTENSIONS)
                out.append((V.Rule("v_name", base + 2, "error", V.MSG_NAME_EXT, prof),
                            f"regexp_matches(json_extract_string(r, '$.name'), '\\.({exts})$')"))
    for prof in (V.VECTOR, V.RASTER):
        out.append((V.Rule("v_path", 100, "error", V.MSG_PATH, prof), f"{_has('$.path')} AND NOT ex"))
    out.append((V.Rule("v_epsg", 110, "missing", "vector/epsg", V.VECTOR), f"NOT {_has('$.vector.epsg')}"))
    out.append((V.Rule("v_epsg", 110, "missing", "raster/epsg", V.RASTER), f"NOT {_has('$.raster.epsg')}"))
    out.append((V.Rule("v_geometry_type", 120, "missing", "vector/geometry_type", V.VECTOR),
                f"NOT {_has('$.vector.geometry_type')}"))
    gts = ", ".join(_q(g) for g in TX.GEOMETRY_TYPES)
    out.append((V.Rule("v_geometry_type", 121, "error", V.MSG_GEOM_TYPE, V.VECTOR),
                f"lower(json_extract_string(r, '$.vector.geometry_type')) NOT IN ({gts})"))
    out.append((V.Rule("v_vector_schema", 130, "missing", "vector/schema", V.VECTOR), f"NOT {_has('$.vector.schema')}"))
    out.append((V.Rule("v_vector_schema", 131, "error", V.MSG_VECTOR_SCHEMA, V.VECTOR),
                f"NOT {_has('$.vector.schema')} OR {_incomplete_sql('$.vector.schema')}"))
    out.append((V.Rule("v_tabular_fields", 140, "missing", "fields", V.TABULAR),
                f"{_has('$.schema')} AND NOT {_has('$.schema.fields')}"))
    out.append((V.Rule("v_tabular_fields", 141, "error", V.MSG_TABULAR_SCHEMA, V.TABULAR),
                f"NOT {_has('$.schema')} OR {_incomplete_sql('$.schema.fields')}"))
    spatial = f"({_has('$.spatial_resolution')} AND {_has('$.spatial_key_field')})"
    names = "COALESCE(json_extract_string(r, '$.schema.fields[*].name'), [])"
    out.append((V.Rule("v_spatial_key", 150, "error", V.MSG_SPATIAL_KEY, V.TABULAR),
                f"{spatial} AND NOT list_contains({names}, json_extract_string(r, '$.spatial_key_field'))"))
    geo = "COALESCE(list_contains(json_extract_string(r, '$.schema.fields[*].type'), 'geometry'), false)"
    out.append((V.Rule("v_has_geometry", 151, "error", V.MSG_NO_GEOMETRY, V.TABULAR), f"NOT {spatial} AND NOT {geo}"))
    return out


def _violations_sql() -> str:
    parts = []
    for rule, cond in _rule_sql():
        parts.append(f"SELECT package, ridx, {_q(rule.key)} AS rule, {rule.ord} AS ord, {_q(rule.kind)} AS kind, "
                     f"{_q(rule.message)} AS message FROM mres_ex WHERE profile = {_q(rule.profile)} "
                     f"AND COALESCE({cond}, false)")
    pk = [("NOT json_exists(j, '$.profile')", V.PACKAGE_RULES[0]),
          ("NOT json_exists(j, '$.resources')", V.PACKAGE_RULES[1]),
          ("json_array_length(j, '$.resources') > 0 AND COALESCE(json_extract_string(j, '$.profile') NOT IN "
           f"({_q(V.VECTOR)}, {_q(V.RASTER)}, {_q(V.TABULAR)}), true)", V.PACKAGE_RULES[2])]
    for cond, rule in pk:
        parts.append(f"SELECT package, CAST(NULL AS INTEGER) AS ridx, {_q(rule.key)}, {rule.ord}, {_q(rule.kind)}, "
                     f"{_q(rule.message)} FROM mpkg WHERE COALESCE({cond}, false)")
    return "\nUNION ALL ".join(parts)


cte("violations", ["mres_ex", "mpkg"], _violations_sql())
VCOLS = "package, ridx, rule, ord, kind, message"


@register("manifest_scan", with_ctes(["mf"], """
SELECT package, CASE WHEN json_valid(json) THEN json_extract_string(json, '$.profile') END AS profile,
  CASE WHEN json_valid(json) THEN json_extract_string(json, '$.name') END AS name,
  CASE WHEN json_valid(json) THEN CAST(json_array_length(json, '$.resources') AS INTEGER) END AS n_resources,
  NOT json_valid(json) AS corrupt FROM mf"""))
def q_manifest_scan(spark, sf):
    m = _manifests(spark, sf)
    return m.select("package", F.col("m.profile").alias("profile"), F.col("m.name").alias("name"),
                    F.when(~F.col("corrupt"), F.size("m.resources")).alias("n_resources"), "corrupt")


@register("manifest_resources", with_ctes(["mres"], """
SELECT package, ridx, json_extract_string(r, '$.name') AS name, json_extract_string(r, '$.path') AS path,
  json_extract_string(r, '$.format') AS format FROM mres"""))
def q_manifest_resources(spark, sf):
    r = _resources(spark, sf).filter(F.col("r").isNotNull())
    return r.select("package", "ridx", F.col("r.name").alias("name"), F.col("r.path").alias("path"),
                    F.col("r.format").alias("format"))


@register("json_field_access", with_ctes(["mres"], """
SELECT package, ridx, COALESCE(json_extract_string(r, '$.vector.epsg'), json_extract_string(r, '$.raster.epsg')) AS epsg,
  json_extract_string(r, '$.vector.geometry_type') AS geometry_type,
  json_extract_string(r, '$.spatial_resolution') AS spatial_resolution,
  json_extract_string(r, '$.dialect.delimiter') AS delimiter,
  CAST(json_extract(r, '$.dialect.doubleQuote') AS BOOLEAN) AS double_quote FROM mres"""))
def q_json_field_access(spark, sf):
    r = _resources(spark, sf).filter(F.col("r").isNotNull())
    return r.select("package", "ridx", F.coalesce("r.vector.epsg", "r.raster.epsg").alias("epsg"),
                    F.col("r.vector.geometry_type").alias("geometry_type"),
                    F.col("r.spatial_resolution").alias("spatial_resolution"),
                    F.col("r.dialect.delimiter").alias("delimiter"), F.col("r.dialect.doubleQuote").alias("double_quote"))


@register("v_schema_violations", with_ctes(["violations"], f"SELECT {VCOLS} FROM violations"))
def q_v_schema_violations(spark, sf):
    return _violations(spark, sf)


RULE_KEYS = ["v_profile", "v_profile_value", "v_vector_props", "v_raster_props", "v_tabular_props", "v_name",
             "v_path", "v_epsg", "v_geometry_type", "v_vector_schema", "v_tabular_fields", "v_spatial_key",
             "v_has_geometry"]


def _rule_query(key):
    def q(spark, sf):
        return _violations(spark, sf).filter(F.col("rule") == key)
    return q


for _k in RULE_KEYS:
    register(_k, with_ctes(["violations"], f"SELECT {VCOLS} FROM violations WHERE rule = '{_k}'"))(_rule_query(_k))


@register("v_repo_layout", with_ctes(["mf", "listing"], f"""
WITH_LISTED SELECT package, CAST(NULL AS INTEGER) AS ridx, 'v_repo_layout' AS rule, ord, 'missing' AS kind, message FROM (
  SELECT package, 0 AS ord, {_q(V.MSG_NO_MANIFEST)} AS message FROM mf
  WHERE package || '/datapackage.json' NOT IN (SELECT path FROM listing)
  UNION ALL SELECT package, 1, {_q(V.MSG_NO_DATA)} FROM mf
  WHERE package || '/datapackage.json' IN (SELECT path FROM listing)
    AND package NOT IN (SELECT split_part(path, '/data/', 1) FROM listing WHERE contains(path, '/data/')))""".replace("WITH_LISTED ", "")))
def q_v_repo_layout(spark, sf):
    return V.repo_layout_violations(manifest_texts(spark, sf), file_listing(spark, sf))


@register("validation_error_count", with_ctes(["violations"], """
SELECT package, count(*) FILTER (WHERE kind = 'error') AS n_errors, count(*) FILTER (WHERE kind = 'missing') AS n_missing,
  count(*) AS n_total FROM violations GROUP BY package"""))
def q_validation_error_count(spark, sf):
    return V.error_counts(_violations(spark, sf))


@register("validation_report", with_ctes(["violations"], """
SELECT package, concat_ws(chr(10),
  'Errors: ' || chr(10) || string_agg(message, chr(10) ORDER BY COALESCE(ridx, -1), ord, message) FILTER (WHERE kind = 'error'),
  'Missing properties: ' || chr(10) || string_agg(message, chr(10) ORDER BY COALESCE(ridx, -1), ord, message)
     FILTER (WHERE kind = 'missing')) AS report
FROM violations GROUP BY package"""))
def q_validation_report(spark, sf):
    return V.validation_report(_violations(spark, sf))


@register("v_gate", with_ctes(["mf", "violations"], """
SELECT mf.package, CASE WHEN NOT json_valid(mf.json) THEN 'skip' WHEN COALESCE(c.n, 0) = 0 THEN 'load'
  WHEN c.n = 1 AND c.geo = 1 THEN 'load_with_warning' ELSE 'skip' END AS decision
FROM mf LEFT JOIN (SELECT package, count(*) AS n, max(CASE WHEN rule = 'v_has_geometry' THEN 1 END) AS geo
                   FROM violations GROUP BY package) c ON c.package = mf.package"""))
def q_v_gate(spark, sf):
    return V.validation_gate(*_validated(spark, sf))


@register("geometry_column_count", with_ctes(["mres"], """
SELECT package, ridx, n_geom, CASE WHEN json_exists(r, '$.spatial_resolution') AND json_exists(r, '$.spatial_key_field')
  THEN lower(json_extract_string(r, '$.spatial_resolution')) = 'none' AND n_geom <= 0 ELSE n_geom <= 0 END
  AS missing_geometry
FROM (SELECT *, CAST(COALESCE(len(list_filter(json_extract_string(r, '$.schema.fields[*].type'),
      lambda x: lower(x) IN ('geom', 'geometry'))), 0) AS INTEGER) AS n_geom FROM mres WHERE profile = 'tabular-data-resource')"""))
def q_geometry_column_count(spark, sf):
    return V.geometry_column_count(_resources(spark, sf))


@register("missing_paths", with_ctes(["mres", "listing"], """
SELECT package, ridx, package || '/' || json_extract_string(r, '$.path') AS path FROM mres
WHERE json_exists(r, '$.path') AND package || '/' || json_extract_string(r, '$.path') NOT IN (SELECT path FROM listing)"""))
def q_missing_paths(spark, sf):
    return V.missing_paths(_resources(spark, sf), file_listing(spark, sf))


@register("sorted_errors", with_ctes(["violations"], "SELECT package, message FROM violations ORDER BY package, message"))
def q_sorted_errors(spark, sf):
    # stored: a sort reads its input twice, first to find the ranges
    found = _violations(spark, sf).select("package", "message")
    return V.sorted_errors(materialize(found, "violations"))


@register("geometry_type_normalize", with_ctes(["mres"], f"""
SELECT package, ridx, CASE lower(json_extract_string(r, '$.vector.geometry_type'))
  {' '.join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in TX.GEOMETRY_TYPES.items())} END AS geometry_type
FROM mres WHERE profile = 'vector-data-resource'"""))
def q_geometry_type_normalize(spark, sf):
    r = _resources(spark, sf).filter(F.col("profile") == V.VECTOR)
    return r.select("package", "ridx", TX.geometry_type_normalize(F.col("r.vector.geometry_type")).alias("geometry_type"))


@register("spatial_resolution_class", with_ctes(["mres"], """
SELECT package, ridx, CASE WHEN starts_with(lower(sr), 'nuts') THEN 'nuts' WHEN starts_with(lower(sr), 'lau') THEN 'lau'
  WHEN lower(sr) = 'none' THEN 'none' END AS spatial_class
FROM (SELECT *, json_extract_string(r, '$.spatial_resolution') AS sr FROM mres WHERE profile = 'tabular-data-resource')"""))
def q_spatial_resolution_class(spark, sf):
    r = _resources(spark, sf).filter(F.col("profile") == V.TABULAR)
    return r.select("package", "ridx", TX.spatial_resolution_class(F.col("r.spatial_resolution")).alias("spatial_class"))


@register("name_length_check", with_ctes(["mres"], """
SELECT package, ridx, length(json_extract_string(r, '$.name')) > 50 AS too_long FROM mres"""))
def q_name_length_check(spark, sf):
    r = _resources(spark, sf).filter(F.col("r").isNotNull())
    return r.select("package", "ridx", TX.name_too_long(F.col("r.name")).alias("too_long"))


@register("extension_check", with_ctes(["mres"], f"""
SELECT package, ridx, regexp_matches(json_extract_string(r, '$.name'), '\\.({'|'.join(TX.BAD_EXTENSIONS)})$')
  AS has_extension FROM mres"""))
def q_extension_check(spark, sf):
    r = _resources(spark, sf).filter(F.col("r").isNotNull())
    return r.select("package", "ridx", TX.has_file_extension(F.col("r.name")).alias("has_extension"))


@register("default_values", with_ctes(["mres"], """
SELECT package, ridx, COALESCE(json_extract_string(r, '$.temporal.start'), '1970-01-01 00:00:00') AS start_date,
  COALESCE(json_extract_string(r, '$.temporal.end'), '1970-01-01 00:00:00') AS end_date,
  COALESCE(json_extract_string(r, '$.temporal_resolution'), 'year') AS temporal_resolution FROM mres"""))
def q_default_values(spark, sf):
    r = _resources(spark, sf).filter(F.col("r").isNotNull()).select(
        "package", "ridx", F.col("r.temporal.start").alias("start_date"), F.col("r.temporal.end").alias("end_date"),
        F.col("r.temporal_resolution").alias("temporal_resolution"))
    return TB.default_values(r)


@register("issue_sink", with_ctes(["mf", "violations"], f"""
SELECT v.package AS dataset, 'Validation error ' || v.package AS name, v.n AS n_messages,
  'Dataset Provider improvement needed' AS issue_type,
  CASE WHEN CAST(substr(v.package, 4) AS BIGINT) % 43 = 0 THEN NULL
    ELSE 'team' || CAST(CAST(substr(v.package, 4) AS BIGINT) % 5 AS VARCHAR) END AS tags
FROM (SELECT package, count(*) AS n FROM violations GROUP BY package) v
UNION ALL SELECT package, 'Validation error ' || package, 1, 'Dataset Provider improvement needed', NULL
FROM mf WHERE NOT json_valid(json)"""))
def q_issue_sink(spark, sf):
    from regiostat.sources.sinks import append_issues, issue_rows, read_issues
    m, viol = _validated(spark, sf)
    viol = viol.unionByName(V.corrupt_manifests(m))
    path = append_issues(spark, issue_rows(viol, m))
    return read_issues(spark, path).select("dataset", "name", "n_messages", "issue_type",
                                           F.array_join("tags", ",").alias("tags"))
