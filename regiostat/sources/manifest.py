"""Dataset manifests (S1, S2, F15): ``datapackage.json`` as nested rows.

A document is parsed once, into a VARIANT; the values, lists and sets of keys of
all its resources are read from that binary form together, by a few casts.  (Cutting
it up into variants builds a new one, with its own names, for each part.)  Only text that is no JSON is corrupt (an
issue instead of a stop); a value of another type than expected is read as far
as it goes, an object or a list as its JSON text.  Which keys a resource *has* is
kept beside their values, because ``"unit": null`` is there and ``unit`` left out
is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat.functions.common import let

#: What a complete field description has.
FIELD_KEYS = ("name", "unit", "type")


#: An object read for its keys alone: its values are cast, not copied.
KEYS = "map<string,struct<_:boolean>>"
FIELDS = f"array<struct<{','.join(f'{k}:string' for k in FIELD_KEYS)}>>"

#: What is read of the list of resources, each by one cast of the whole list: the
#: entries' values as text (an object as its JSON text), their inner values, their keys,
#: the keys of inner objects and those of each field description.
TEXTS = ("name", "path", "format", "unit", "encoding", "vector", "raster", "schema", "dialect",
         "spatial_resolution", "spatial_key_field", "temporal", "temporal_resolution")
RESOURCE_READS = {
    "texts": f"struct<{','.join(f'{k}:string' for k in TEXTS)}>",
    "inner": (f"struct<vector:struct<epsg:string,geometry_type:string,schema:{FIELDS}>,raster:struct<epsg:string>,"
              f"schema:struct<fields:{FIELDS}>,dialect:struct<delimiter:string,doubleQuote:string>,"
              "temporal:struct<start:string,end:string>>"),
    "keys": KEYS,
    "inner_keys": f"struct<vector:{KEYS},raster:{KEYS},schema:{KEYS}>",
    "field_keys": f"struct<vector:struct<schema:array<{KEYS}>>,schema:struct<fields:array<{KEYS}>>>",
}


def _keys(m: Column) -> Column:
    """Keys of an object read as :data:`KEYS` (empty if there is none)."""
    return F.coalesce(F.map_keys(m), F.array().cast("array<string>"))


def _complete(entries: Column) -> Column:
    """Every entry of the list has all of :data:`FIELD_KEYS`."""
    return F.forall(entries, lambda x: F.size(F.array_intersect(_keys(x), F.array(*[F.lit(k) for k in FIELD_KEYS]))) == len(FIELD_KEYS))


def _fields(entries: Column) -> Column:
    return F.transform(entries, lambda x: F.struct(*[x[k].alias(k) for k in FIELD_KEYS]))


def _resource(z: Column) -> Column:
    """One resource: its values, and ``keys``, ``vector_keys``, ``raster_keys``,
    ``schema_keys``, ``vector_complete``, ``fields_complete``."""
    r, inner, keys, inner_keys, field_keys = [z[str(i)] for i in range(len(RESOURCE_READS))]

    def values(key: str, *names: str) -> Column:
        """A struct of inner values, null if there is nothing under ``key``."""
        return F.when(r[key].isNotNull(), F.struct(*[inner[key][k].alias(k) for k in names]))

    def listed(key: str, name: str, *names: str) -> Column:
        return F.when(r[key].isNotNull(), F.struct(*[inner[key][k].alias(k) for k in names], _fields(inner[key][name]).alias(name)))

    double = F.lower(inner["dialect"]["doubleQuote"])
    quote = F.when(double == "true", True).when(double == "false", False)
    dialect = F.when(r["dialect"].isNotNull(), F.struct(inner["dialect"]["delimiter"].alias("delimiter"), quote.alias("doubleQuote")))
    return F.struct(
        *[r[k].alias(k) for k in ("name", "path", "format", "unit", "encoding")],
        listed("vector", "schema", "epsg", "geometry_type").alias("vector"), values("raster", "epsg").alias("raster"),
        listed("schema", "fields").alias("schema"), dialect.alias("dialect"),
        *[r[k].alias(k) for k in ("spatial_resolution", "spatial_key_field")],
        values("temporal", "start", "end").alias("temporal"), r["temporal_resolution"].alias("temporal_resolution"),
        _keys(keys).alias("keys"), *[_keys(inner_keys[k]).alias(f"{k}_keys") for k in ("vector", "raster", "schema")],
        _complete(field_keys["vector"]["schema"]).alias("vector_complete"), _complete(field_keys["schema"]["fields"]).alias("fields_complete"))


def parse_manifest(json_text: Column | str) -> Column:
    """JSON text -> manifest struct, NULL if the text is no JSON."""
    c = F.col(json_text) if isinstance(json_text, str) else json_text

    def contributors(people: Column) -> Column:
        """Titles, if every entry is an object (read as null if it is not)."""
        titles = F.filter(F.transform(people, lambda x: F.struct(x["title"].alias("title"))), lambda x: x["title"].isNotNull())
        return F.when(F.forall(people, lambda x: x.isNotNull()), titles)

    def typed(m: Column) -> Column:
        people = F.try_variant_get(m, "$.contributors", "array<struct<title:string>>")
        resources = F.arrays_zip(*[F.try_variant_get(m, "$.resources", f"array<{t}>") for t in RESOURCE_READS.values()])
        return F.when(m.isNotNull(), F.struct(*[F.try_variant_get(m, f"$.{k}", "string").alias(k) for k in ("profile", "name", "version")],
                                              let(people, contributors).alias("contributors"), F.transform(resources, _resource).alias("resources"),
                                              _keys(F.try_variant_get(m, "$", KEYS)).alias("keys")))

    return let(F.try_parse_json(c), typed)


def manifest_scan(texts: DataFrame, package_col: str = "package", text_col: str = "json") -> DataFrame:
    """S1 over a (package, json text) frame: one row per package with
    ``m`` (the struct) and ``corrupt`` (bool)."""
    # parse once per document, however often the result is used downstream:
    # the generator output is a fresh column that projections cannot inline
    return texts.select(package_col, F.inline(F.array(let(parse_manifest(text_col), lambda m: F.struct(m.alias("m"), m.isNull().alias("corrupt"))))))


def read_manifest_files(spark: SparkSession, path_glob: str) -> DataFrame:
    """S1 over files: one row per ``datapackage.json`` (whole file as one
    value); the package is the file's directory."""
    t = spark.read.text(path_glob, wholetext=True).select(
        F.regexp_extract(F.input_file_name(), r"([^/]+)/datapackage\.json$", 1).alias("package"),
        F.col("value").alias("json"))
    return manifest_scan(t)


def manifest_resources(manifests: DataFrame) -> DataFrame:
    """One row per (package, resource index, resource)."""
    return manifests.filter(~F.col("corrupt")).select(
        "package", F.col("m.profile").alias("profile"),
        F.posexplode_outer("m.resources").alias("ridx", "r"))
