"""Session construction and shared-storage helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "regiostat",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings this library relies on.

    On a cluster the master and most sizing come from spark-submit; only
    defaults that matter for correctness (UTC, ANSI) are forced here.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    Uses the cluster's ``spark.checkpoint.dir``.  Only a session that runs in
    one process (local tests) may do without: it gets a folder under the
    system temp dir.  Anywhere else that folder would not be shared, so a
    missing setting is an error.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="regiostat-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


#: Staged paths of each application, in order of creation.
_STAGED: list[str] = []


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder.  It is deleted when
    the application ends, or at the end of a :func:`staged_tables` block."""
    path = f"{checkpoint_root(spark).rstrip('/')}/regiostat-stage/{name}-{uuid.uuid4().hex[:12]}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    _STAGED.append(path)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table folder, wherever it is stored."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def write_text(spark: SparkSession, path: str, text: str) -> str:
    """A small text (a manifest) as one file, wherever files are stored."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop, True)
    try:
        out.write(text.encode("utf-8"))
    finally:
        out.close()
    return path


@contextmanager
def staged_tables(spark: SparkSession):
    """Tables staged inside the block are deleted at its end; results that
    read them must be written or collected before."""
    mark = len(_STAGED)
    try:
        yield
    finally:
        for path in _STAGED[mark:]:
            drop_path(spark, path)
        del _STAGED[mark:]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """``df`` dealt to one task per ``rows`` rows.  For stored tables whose rows are
    small but costly to work on: Spark cuts files by bytes, so a few MB with
    millions of them would be one task."""
    return df.repartition(max(1, -(-df.count() // rows)))


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Compute ``df`` once and cut its lineage: written as a Parquet table in
    the shared checkpoint folder and read back (one job; survives executor
    loss; later scans get column pruning and filter pushdown).  Never a
    machine-local copy.  Used where a result feeds several consumers."""
    path = staging_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
