"""Tabular ingest: typed star-schema facts from CSV text.

The manifest's field list drives a dynamic schema.  Every step is a
projection or an equi-join over the whole dataset (one distributed write at
the end) instead of per-row statements.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat.config import DEFAULT_RESOLUTION, DEFAULT_START, MAX_TEXT_LENGTH, NUTS_VINTAGE
from regiostat.functions.common import let
from regiostat.functions.text import parse_boolean, sanitize_name_py
from regiostat.functions.timefuncs import epoch_to_timestamp, normalize_granularity, parse_date_multi

# Declared type -> Spark type (lower-cased declared type).
TYPE_MAP = {
    "string": "string", "integer": "bigint", "number": "decimal(20,2)", "double": "decimal(20,2)",
    "float": "decimal(20,2)", "boolean": "boolean", "date": "date", "datetime": "timestamp_ntz",
    "timestamp": "timestamp_ntz", "geom": "geometry", "geometry": "geometry",
}
# Types whose unit is blanked.
NO_UNIT_TYPES = {"string", "boolean", "date", "datetime", "timestamp", "geom", "geometry"}


@dataclass
class FieldSpec:
    name: str
    type: str
    unit: str | None = None


@dataclass
class ColumnPlan:
    raw: str            # header name in the file
    column: str         # sanitised column name
    type: str           # declared type, lower-cased
    spark_type: str
    unit: str | None


@dataclass
class SchemaPlan:
    columns: list[ColumnPlan] = field(default_factory=list)
    skipped: list[tuple[str, str]] = field(default_factory=list)   # (field, declared type)

    @property
    def geometry_count(self) -> int:
        return sum(1 for c in self.columns if c.spark_type == "geometry")


def schema_plan(fields: list[FieldSpec], dedupe_on_raw: bool = False) -> SchemaPlan:
    """P2 + P3 at schema level: sanitised, de-duplicated names (``_1``
    appended while taken) and the Spark type per field; unknown types are
    skipped (and reported).  ``dedupe_on_raw=True`` reproduces the original,
    which looks duplicates up in the raw-name list."""
    plan = SchemaPlan()
    taken: list[str] = []
    for f in fields:
        t = f.type.lower()
        if t not in TYPE_MAP:
            plan.skipped.append((f.name, f.type))
            continue
        col = sanitize_name_py(f.name)
        while col in (taken if not dedupe_on_raw else [c.raw for c in plan.columns]):
            col += "_1"
        taken.append(col)
        unit = None if t in NO_UNIT_TYPES else (f.unit or None)
        plan.columns.append(ColumnPlan(f.name, col, t, TYPE_MAP[t], unit))
    return plan


def sanitize_columns(raw: DataFrame, plan: SchemaPlan) -> DataFrame:
    """Project the planned raw columns under their sanitised names."""
    return raw.select(*[F.col(f"`{c.raw}`").alias(c.column) for c in plan.columns])


def empty_to_null(c: Column) -> Column:
    """``''`` -> NULL."""
    return F.nullif(c, F.lit(""))


def typed_value(raw: Column, declared: str) -> Column:
    """Text -> typed value; NULL when it does not fit the type."""
    t = TYPE_MAP[declared]
    if declared == "boolean":
        return parse_boolean(raw)
    if declared in ("datetime", "timestamp"):
        return parse_date_multi(raw)
    if declared == "date":
        return parse_date_multi(raw).cast("date")
    if t == "geometry":
        from regiostat.functions.geometry import ewkt_parse
        return let(ewkt_parse(raw), lambda g: F.when(g["parts"].isNotNull(), g))
    if t == "string":
        return raw
    return raw.try_cast(t)


def typed_projection(raw: DataFrame, plan: SchemaPlan, keep_raw: bool = True) -> DataFrame:
    """P6 + P3: typed columns; the raw text is kept as ``_raw_<col>`` for the
    reject check."""
    r = sanitize_columns(raw, plan)
    cols = []
    for c in plan.columns:
        txt = empty_to_null(F.col(c.column))
        cols.append(typed_value(txt, c.type).alias(c.column))
        if keep_raw:
            cols.append(txt.alias(f"_raw_{c.column}"))
    return r.select(*cols)


def reject_condition(plan: SchemaPlan) -> Column:
    """P10: some value is present as text but does not fit its type, or a
    string is longer than the column allows."""
    bad = F.lit(False)
    for c in plan.columns:
        raw, val = F.col(f"_raw_{c.column}"), F.col(c.column)
        bad = bad | (raw.isNotNull() & val.isNull())
        if c.spark_type == "string":
            bad = bad | (F.length(raw) > MAX_TEXT_LENGTH)
    return bad


def reject_rows(typed: DataFrame, plan: SchemaPlan) -> tuple[DataFrame, DataFrame]:
    """P10: (accepted, rejected) frames; raw columns dropped from accepted."""
    flagged = typed.withColumn("_reject", reject_condition(plan))
    raws = [f"_raw_{c.column}" for c in plan.columns]
    accepted = flagged.filter(~F.col("_reject")).drop("_reject", *raws)
    rejected = flagged.filter(F.col("_reject")).drop("_reject")
    return accepted, rejected


def unit_columns(df: DataFrame, plan: SchemaPlan) -> DataFrame:
    """Constant ``<col>_unit`` columns for fields with a unit, appended
    after the data columns."""
    units = {f"{c.column}_unit": F.lit(c.unit) for c in plan.columns if c.unit}
    return df.withColumns(units) if units else df


def default_values(resources: DataFrame) -> DataFrame:
    """Temporal start/end default ``1970-01-01 00:00:00``, resolution
    default ``year``."""
    return resources.withColumns({
        "start_date": F.coalesce(F.col("start_date"), F.lit(DEFAULT_START)),
        "end_date": F.coalesce(F.col("end_date"), F.lit(DEFAULT_START)),
        "temporal_resolution": F.coalesce(F.col("temporal_resolution"), F.lit(DEFAULT_RESOLUTION)),
    })


def metadata_columns(df: DataFrame, start_date: str, granularity: str, time_dim: DataFrame) -> DataFrame:
    """P5: ``date``, ``timestamp`` and ``fk_time_id`` from the manifest on
    every feature (J3 lookup of the one start date: a scalar, no join)."""
    ts, gran = parse_date_multi(F.lit(start_date)), normalize_granularity(F.lit(granularity))
    found = time_dim.filter((F.col("timestamp") == ts) & (F.col("granularity") == gran)).agg(F.min("id")).first()[0]
    return df.withColumns({"date": ts.cast("date"), "timestamp": ts, "fk_time_id": F.lit(found).cast("bigint")})


def row_time(df: DataFrame, plan: SchemaPlan, start_date: str, last_column_only: bool = False) -> Column:
    """the row's time: a ``datetime`` column, else a ``timestamp`` column
    (epoch seconds), else the manifest's start date.  ``last_column_only``
    reproduces the original, where the value survives only when the time
    column is the last column of the row."""
    names = [c.column for c in plan.columns]
    cands = []
    for c in plan.columns:
        if c.column == "datetime":
            cands.append(F.col("datetime"))
        elif c.column == "timestamp":
            cands.append(epoch_to_timestamp(F.col("_epoch_timestamp")))
    if last_column_only and names and names[-1] not in ("datetime", "timestamp"):
        cands = []
    return F.coalesce(*cands, parse_date_multi(F.lit(start_date)))


@dataclass
class IngestResult:
    fact: DataFrame
    time_dim: DataFrame
    rejected: DataFrame
    unmatched: DataFrame | None
    plan: SchemaPlan
    issues: DataFrame


REJECT_MESSAGE = "The dataset was not loaded: rows do not fit the declared types."


def ingest_tabular(raw: DataFrame, fields: list[FieldSpec], regions: DataFrame | None,
                   spatial_resolution: str | None, key_field: str | None, time_dim: DataFrame | None,
                   temporal_resolution: str = DEFAULT_RESOLUTION, start_date: str = DEFAULT_START,
                   vintage: str = NUTS_VINTAGE, all_or_nothing: bool = True, dataset: str = "dataset") -> IngestResult:
    """S3 output -> typed fact table with region and time keys, ids and units.

    One pass over the file types every row, flags the bad ones, looks up the
    region and stores the result; everything else reads that table.  Ids
    follow the storage order (no sort).  ``all_or_nothing``: a dataset with
    any rejected row loads no rows and leaves an issue; otherwise rejected
    rows are left out."""
    from regiostat.operators import dims as D
    plan = schema_plan(fields)
    typed = typed_projection(raw, plan)
    if any(c.column == "timestamp" for c in plan.columns):
        typed = typed.withColumn("_epoch_timestamp", F.col("_raw_timestamp"))
        typed = typed.withColumn("timestamp", epoch_to_timestamp(F.col("_raw_timestamp")))
    typed = typed.withColumns({"_reject": reject_condition(plan), "_ts": row_time(typed, plan, start_date),
                               "_gr": normalize_granularity(F.lit(temporal_resolution))})
    key = sanitize_name_py(key_field) if key_field else None
    res = (spatial_resolution or "").lower()
    out = None
    if regions is not None and key and res.startswith(("nuts", "lau")):
        code, vin, out = ("nuts_id", vintage, "fk_nuts_gid") if res.startswith("nuts") else ("comm_id", None, "fk_lau_gid")
        dim = D.region_dimension(regions, code, vin)
        typed = D.join_dimension(typed.withColumn("_code", F.upper(F.col(key))), dim, "_code", "left").drop("_code")
    stored = D.materialize(typed, "typed")
    n_bad = stored.agg(F.count(F.when(F.col("_reject"), 1))).first()[0]
    names = [c.column for c in plan.columns]
    rejected = stored.filter("_reject").select(*names, *[f"_raw_{c}" for c in names])
    accepted = stored.filter(F.lit(False) if all_or_nothing and n_bad else ~F.col("_reject"))
    unmatched = None
    if out:
        unmatched = accepted.filter("_gid IS NULL").groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n_rows"))
        accepted = accepted.filter("_gid IS NOT NULL")
    keys = accepted.select(F.col("_ts").alias("timestamp"), F.col("_gr").alias("granularity"))
    new_dim = D.time_dim_upsert(time_dim, keys)
    fact = D.time_lookup(accepted, new_dim, "_ts", "_gr").select(*names, *([F.col("_gid").alias(out)] if out else []), "fk_time_id")
    fact = unit_columns(fact, plan)
    columns = list(fact.columns)
    issues = raw.sparkSession.range(1 if all_or_nothing and n_bad else 0).select(
        F.lit(dataset).alias("dataset"), F.lit(f"Integration error {dataset}").alias("name"), F.lit(REJECT_MESSAGE).alias("description"),
        F.lit("Dataset Provider improvement needed").alias("issue_type"), F.lit(None).cast("array<string>").alias("tags"), F.lit(n_bad).cast("bigint").alias("n_messages"))
    return IngestResult(D.serial_id(fact).select("id", *columns), new_dim, rejected, unmatched, plan, issues)


def add_missing_column(df: DataFrame, name: str, dtype: str) -> DataFrame:
    """``ADD COLUMN IF NOT EXISTS name dtype`` (NULL-filled)."""
    if name.lower() in (c.lower() for c in df.columns):
        return df
    return df.withColumn(name, F.lit(None).cast(dtype))
