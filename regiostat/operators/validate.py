"""Manifest validation as a frame.

One row per (package, resource, rule, message).  Every rule is a column
predicate evaluated in a single projection over the exploded resources (no
per-rule pass, no Python loop over packages); file existence is a left anti
join against a file listing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat.functions.text import GEOMETRY_TYPES, has_file_extension, name_too_long

VECTOR, RASTER, TABULAR = "vector-data-resource", "raster-data-resource", "tabular-data-resource"

# Validation messages.
MSG_NAME_LONG = "resource/name length is too long (max 50 char.)"
MSG_NAME_EXT = "resource/name should not contain a file extension (extension is in resource/path)"
MSG_PATH = "attribute path does not link to an existing file"
MSG_GEOM_TYPE = ("geometry_type is not set correctly (must be either (multi)point, (multi)linestring or "
                 "(multi)polygon)")
MSG_VECTOR_SCHEMA = "errors in schema definition (schema: [{name, unit, type},...])"
MSG_TABULAR_SCHEMA = "errors in schema definition (schema: fields: [{name, unit, type},...])"
MSG_SPATIAL_KEY = "spatial_key_field does not refer to an existing field name"
MSG_NO_GEOMETRY = ("no geometry provided (nuts/lau reference [attribute spatial_key_field and spatial_resolution] "
                   "or geometry field)\n\tThe dataset will be integrated as is but make sure that no geometry is "
                   "needed.")
MSG_PROFILE = ("'profile' contains an unsupported value! Use only vector-data-resource, raster-data-resource or "
               "tabular-data-resource")
MSG_NO_MANIFEST = "datapackage.json file missing or not in correct directory"
MSG_NO_DATA = "data directory missing"
MSG_CORRUPT = "datapackage.json is not valid JSON"

# Required resource properties per profile, in check order.
PROPS = {
    VECTOR: ["name", "path", "format", "unit", "vector"],
    RASTER: ["name", "path", "unit", "format", "raster"],
    TABULAR: ["name", "path", "schema", "encoding", "format", "dialect"],
}
PROP_RULE = {VECTOR: "v_vector_props", RASTER: "v_raster_props", TABULAR: "v_tabular_props"}


@dataclass(frozen=True)
class Rule:
    key: str
    ord: int
    kind: str        # 'error' | 'missing'
    message: str
    profile: str | None   # None = package level


def _lacks(keys: Column, key: str) -> Column:
    """The key is not there; one with a null value is."""
    return ~F.array_contains(keys, key)


def resource_rule_table():
    """(Rule, condition builder) pairs of the rules on a resource alone;
    builders take the resource struct column ``r``."""
    out = []
    for prof, props in PROPS.items():
        for i, p in enumerate(props):
            base = 10 * (i + 1)
            out.append((Rule(PROP_RULE[prof], base, "missing", f"resources/{p}", prof),
                        lambda r, p=p: _lacks(r["keys"], p)))
            if p == "name":
                out.append((Rule("v_name", base + 1, "error", MSG_NAME_LONG, prof),
                            lambda r: name_too_long(r["name"])))
                out.append((Rule("v_name", base + 2, "error", MSG_NAME_EXT, prof),
                            lambda r: has_file_extension(r["name"])))
    out.append((Rule("v_epsg", 110, "missing", "vector/epsg", VECTOR), lambda r: _lacks(r["vector_keys"], "epsg")))
    out.append((Rule("v_epsg", 110, "missing", "raster/epsg", RASTER), lambda r: _lacks(r["raster_keys"], "epsg")))
    out.append((Rule("v_geometry_type", 120, "missing", "vector/geometry_type", VECTOR),
                lambda r: _lacks(r["vector_keys"], "geometry_type")))
    out.append((Rule("v_geometry_type", 121, "error", MSG_GEOM_TYPE, VECTOR),
                lambda r: ~F.lower(r["vector"]["geometry_type"]).isin(*GEOMETRY_TYPES)))
    out.append((Rule("v_vector_schema", 130, "missing", "vector/schema", VECTOR),
                lambda r: _lacks(r["vector_keys"], "schema")))
    out.append((Rule("v_vector_schema", 131, "error", MSG_VECTOR_SCHEMA, VECTOR),
                lambda r: _lacks(r["vector_keys"], "schema") | ~F.coalesce(r["vector_complete"], F.lit(True))))
    fields = lambda r: r["schema"]["fields"]
    out.append((Rule("v_tabular_fields", 140, "missing", "fields", TABULAR),
                lambda r: ~_lacks(r["keys"], "schema") & _lacks(r["schema_keys"], "fields")))
    out.append((Rule("v_tabular_fields", 141, "error", MSG_TABULAR_SCHEMA, TABULAR),
                lambda r: _lacks(r["keys"], "schema") | ~F.coalesce(r["fields_complete"], F.lit(True))))
    spatial = lambda r: ~_lacks(r["keys"], "spatial_resolution") & ~_lacks(r["keys"], "spatial_key_field")
    names = lambda r: F.coalesce(F.transform(fields(r), lambda f: f["name"]), F.array().cast("array<string>"))  # noqa
    has_geom = lambda r: F.coalesce(F.exists(fields(r), lambda f: f["type"] == "geometry"), F.lit(False))  # noqa
    out.append((Rule("v_spatial_key", 150, "error", MSG_SPATIAL_KEY, TABULAR),
                lambda r: spatial(r) & ~F.array_contains(names(r), r["spatial_key_field"])))
    out.append((Rule("v_has_geometry", 151, "error", MSG_NO_GEOMETRY, TABULAR),
                lambda r: ~spatial(r) & ~has_geom(r)))
    return out


PACKAGE_RULES = [
    Rule("v_profile", 1, "missing", "profile", None),
    Rule("v_profile", 2, "missing", "resources", None),
    Rule("v_profile_value", 3, "error", MSG_PROFILE, None),
]
# the declared file is not there: vector and raster resources
FILE_RULE = Rule("v_path", 100, "error", MSG_PATH, None)
FILE_PROFILES = (VECTOR, RASTER)
RULE_COLUMNS = ["package", "ridx", "rule", "ord", "kind", "message"]


def _emit(rule: Rule, cond: Column) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), F.struct(
        F.lit(rule.key).alias("rule"), F.lit(rule.ord).alias("ord"), F.lit(rule.kind).alias("kind"),
        F.lit(rule.message).alias("message")))


def _explode_rules(df: DataFrame, entries: list[Column]) -> DataFrame:
    arr = F.filter(F.array(*entries), lambda x: x.isNotNull())
    return df.select("package", "ridx", F.explode(arr).alias("v")).select(
        "package", "ridx", "v.rule", "v.ord", "v.kind", "v.message")


def without_file(resources: DataFrame, listing: DataFrame) -> DataFrame:
    """``(package, ridx, path)`` of the resources whose declared path
    ``package/path`` is not in ``listing`` (a left anti join).  Merged, as the
    size of a listing that is derived from a few keys is not known beforehand:
    Spark takes it for that of the keys and would broadcast millions of paths."""
    declared = resources.filter(F.col("r.path").isNotNull()).select(
        "package", "ridx", F.concat_ws("/", "package", F.col("r.path")).alias("path"))
    return declared.join(listing.select("path").hint("merge"), "path", "left_anti").select("package", "ridx", "path")


def resource_violations(resources: DataFrame, listing: DataFrame | None) -> DataFrame:
    """V4-V14 over S2 output ``(package, profile, ridx, r)``; ``listing``
    holds existing file paths ``package/path`` (column ``path``).  Only the
    rule on files meets the listing, with a few short columns; the others read
    the resources where they lie."""
    res = resources.filter(F.col("r").isNotNull())
    r = F.col("r")
    out = _explode_rules(res, [_emit(rule, (F.col("profile") == rule.profile) & build(r))
                               for rule, build in resource_rule_table()])
    if listing is None:
        return out
    gone = without_file(res.filter(F.col("profile").isin(*FILE_PROFILES)), listing)
    return out.unionByName(gone.select("package", "ridx", *[F.lit(x).alias(c) for c, x in (
        ("rule", FILE_RULE.key), ("ord", FILE_RULE.ord), ("kind", FILE_RULE.kind), ("message", FILE_RULE.message))]))


def package_violations(manifests: DataFrame) -> DataFrame:
    """V2, V3 over S1 output (valid JSON only)."""
    m = manifests.filter(~F.col("corrupt")).withColumn("ridx", F.lit(None).cast("int"))
    prof, res = F.col("m.profile"), F.col("m.resources")
    conds = [_lacks(F.col("m.keys"), "profile"), _lacks(F.col("m.keys"), "resources"),
             (F.size(res) > 0) & ~F.coalesce(prof.isin(VECTOR, RASTER, TABULAR), F.lit(False))]
    return _explode_rules(m, [_emit(rule, c) for rule, c in zip(PACKAGE_RULES, conds)])


def repo_layout_violations(packages: DataFrame, listing: DataFrame) -> DataFrame:
    """V1: packages without a ``datapackage.json``, or with one but without a
    file below ``data/``, in the listing."""
    have = listing.filter(F.col("path").endswith("/datapackage.json")).select(
        F.regexp_extract("path", r"^(.*)/datapackage\.json$", 1).alias("package")).distinct()
    data = listing.select(F.regexp_extract("path", r"^(.*?)/data/", 1).alias("package")).filter("package <> ''").distinct()
    known = packages.select("package").distinct()

    def rows(df: DataFrame, order: int, message: str) -> DataFrame:
        return df.select("package", F.lit(None).cast("int").alias("ridx"), F.lit("v_repo_layout").alias("rule"),
                         F.lit(order).alias("ord"), F.lit("missing").alias("kind"), F.lit(message).alias("message"))

    return (rows(known.join(have, "package", "left_anti"), 0, MSG_NO_MANIFEST)
            .unionByName(rows(known.join(have, "package", "left_semi").join(data, "package", "left_anti"), 1, MSG_NO_DATA)))


def corrupt_manifests(manifests: DataFrame) -> DataFrame:
    """S1 failure path: malformed JSON -> one issue row per package."""
    return manifests.filter(F.col("corrupt")).select(
        "package", F.lit(None).cast("int").alias("ridx"), F.lit("manifest_scan").alias("rule"),
        F.lit(0).alias("ord"), F.lit("error").alias("kind"), F.lit(MSG_CORRUPT).alias("message"))


def all_violations(manifests: DataFrame, resources: DataFrame, listing: DataFrame | None) -> DataFrame:
    """The union of all rule frames."""
    return (package_violations(manifests).unionByName(resource_violations(resources, listing))
            .select(*RULE_COLUMNS))


def error_counts(violations: DataFrame) -> DataFrame:
    """Errors + missing properties per package (one partial+final
    aggregation; packages with no violation are not listed)."""
    return violations.groupBy("package").agg(
        F.count(F.when(F.col("kind") == "error", 1)).alias("n_errors"),
        F.count(F.when(F.col("kind") == "missing", 1)).alias("n_missing"),
        F.count(F.lit(1)).alias("n_total"))


def validation_report(violations: DataFrame) -> DataFrame:
    """A10: per package ``Errors:`` then ``Missing properties:`` sections,
    messages in check order.  (The original overwrites the error section
    when both exist; both are kept here.)"""
    return counted_report(violations).drop("n_messages")


def counted_report(violations: DataFrame) -> DataFrame:
    """The report with ``n_messages``, from one aggregation."""
    v = violations.withColumn("k", F.when(F.col("kind") == "error", 0).otherwise(1))
    g = v.groupBy("package").agg(F.array_sort(F.collect_list(F.struct(
        "k", F.coalesce("ridx", F.lit(-1)).alias("ri"), "ord", "message"))).alias("items"))
    errs = F.transform(F.filter("items", lambda x: x["k"] == 0), lambda x: x["message"])
    miss = F.transform(F.filter("items", lambda x: x["k"] == 1), lambda x: x["message"])
    e_txt = F.when(F.size(errs) > 0, F.concat(F.lit("Errors: \n"), F.array_join(errs, "\n")))
    m_txt = F.when(F.size(miss) > 0, F.concat(F.lit("Missing properties: \n"), F.array_join(miss, "\n")))
    return g.select("package", F.concat_ws("\n", e_txt, m_txt).alias("report"), F.size("items").cast("bigint").alias("n_messages"))


def validation_gate(manifests: DataFrame, violations: DataFrame) -> DataFrame:
    """``load`` with no violation; ``load_with_warning`` when the only
    violation is the missing-geometry one; else ``skip`` (corrupt manifests
    are skipped too)."""
    c = violations.groupBy("package").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("rule") == "v_has_geometry", 1)).alias("geo"))
    p = manifests.select("package", "corrupt").join(c, "package", "left")
    decision = (F.when(F.col("corrupt"), "skip").when(F.coalesce("n", F.lit(0)) == 0, "load")
                 .when((F.col("n") == 1) & (F.col("geo") == 1), "load_with_warning").otherwise("skip"))
    return p.select("package", decision.alias("decision"))


def geometry_column_count(resources: DataFrame) -> DataFrame:
    """Per tabular resource, the number of geometry fields and the
    ``missing_geometry`` decision."""
    t = resources.filter(F.col("profile") == TABULAR)
    fl = F.col("r.schema.fields")
    n = F.when(fl.isNull(), F.lit(0)).otherwise(
        F.size(F.filter(fl, lambda f: F.lower(f["type"]).isin("geom", "geometry"))))
    sr = F.col("r.spatial_resolution")
    has_spatial = ~_lacks(F.col("r.keys"), "spatial_resolution") & ~_lacks(F.col("r.keys"), "spatial_key_field")
    missing = F.when(has_spatial, (F.lower(sr) == "none") & (n <= 0)).otherwise(n <= 0)
    return t.select("package", "ridx", n.alias("n_geom"), missing.alias("missing_geometry"))


def missing_paths(resources: DataFrame, listing: DataFrame) -> DataFrame:
    """Declared paths without a file, with the path first."""
    return without_file(resources, listing).select("path", "package", "ridx")


def sorted_errors(violations: DataFrame) -> DataFrame:
    """O1: violations in (package, message) order."""
    return violations.select("package", "message").orderBy("package", "message")
