"""Table sinks (S7-S11): replace, append, append-a-query, views, issues.

Tables are Parquet directories in shared storage.  A replace writes a new
directory, then swaps it in; appends compare the
schema first (the original's column/type/value count check), then write
once for the whole frame.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat.session import staging_path


def table_replace(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """``DROP ... CASCADE`` + ``CREATE`` + load.  The new table is written
    beside the old one and takes its place when it is complete, so ``df`` may
    read the table it replaces; column names lower-cased.  The old table is
    moved aside, the new one in, and only then the old one deleted: a stop in
    between loses nothing (:func:`recover_table`, also called here)."""
    recover_table(df.sparkSession, path)
    out = df.toDF(*[c.lower() for c in df.columns])
    fresh = f"{path.rstrip('/')}.{uuid.uuid4().hex[:12]}"
    w = out.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(fresh)
    fs, old = _file_system(df.sparkSession, path)
    _, aside = _file_system(df.sparkSession, _aside(path))
    _, new = _file_system(df.sparkSession, fresh)
    if fs.exists(aside):  # left by a replace that stopped before its last step
        fs.delete(aside, True)
    if fs.exists(old) and not fs.rename(old, aside):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(new, old):
        recover_table(df.sparkSession, path)
        raise OSError(f"could not move {fresh} to {path}")
    fs.delete(aside, True)
    return path


def _aside(path: str) -> str:
    return f"{path.rstrip('/')}.previous"


def recover_table(spark: SparkSession, path: str) -> bool:
    """After a replace that stopped between its two moves, the old table
    takes its place again; true if it had to."""
    fs, old = _file_system(spark, path)
    _, aside = _file_system(spark, _aside(path))
    return bool(not fs.exists(old) and fs.exists(aside) and fs.rename(aside, old))


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def check_append_schema(target: DataFrame, rows: DataFrame, allow_missing: bool = False) -> None:
    """S8 check: same column names (case-insensitive) and types."""
    t = {f.name.lower(): f.dataType for f in target.schema.fields}
    r = {f.name.lower(): f.dataType for f in rows.schema.fields}
    extra = set(r) - set(t)
    missing = set(t) - set(r)
    if extra or (missing and not allow_missing):
        raise ValueError(f"column mismatch: extra {sorted(extra)}, missing {sorted(missing)}")
    bad = [c for c in r if c in t and r[c] != t[c]]
    if bad:
        raise ValueError(f"type mismatch in {bad}")


def table_append(spark: SparkSession, rows: DataFrame, path: str, allow_missing: bool = False) -> str:
    """Append a frame (or a query result) to a table directory."""
    fs, folder = _file_system(spark, path)
    target = spark.read.parquet(path) if fs.exists(folder) else None  # the first write creates the table
    out = rows.toDF(*[c.lower() for c in rows.columns])
    if target is not None:
        check_append_schema(target, out, allow_missing)
        if allow_missing:
            for f in target.schema.fields:
                if f.name not in out.columns:
                    out = out.withColumn(f.name, F.lit(None).cast(f.dataType))
        out = out.select(*target.columns)
    out.write.mode("append").parquet(path)
    return path


def publish_view(spark: SparkSession, name: str, sql: str) -> DataFrame:
    """``CREATE VIEW`` in the catalog.  ``sql`` reads stored tables, so
    the view stays when the session ends (as long as the catalog does)."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")
    return spark.table(name)


ISSUE_TYPE = "Dataset Provider improvement needed"


def issue_rows(violations: DataFrame, manifests: DataFrame) -> DataFrame:
    """One issue per package with violations; tags = contributor titles."""
    from regiostat.operators.validate import counted_report
    rep = counted_report(violations).filter(F.col("package").isNotNull())
    tags = manifests.select("package", F.transform("m.contributors", lambda c: c["title"]).alias("tags"))
    j = rep.join(tags, "package", "left")
    return j.select(F.col("package").alias("dataset"), F.concat(F.lit("Validation error "), "package").alias("name"),
                    F.concat(F.lit("The repository validation was not successful.\n"), "report").alias("description"),
                    F.lit(ISSUE_TYPE).alias("issue_type"), "tags", "n_messages")


def append_issues(spark: SparkSession, issues: DataFrame, path: str | None = None) -> str:
    """Append issue rows to the issue table (a new one under the
    shared folder unless ``path`` is given)."""
    path = path or staging_path(spark, "issues")
    issues.write.mode("append").parquet(path)
    return path


def read_issues(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
