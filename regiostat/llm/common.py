"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space of the word rules: blank and the controls 9 to 13.
SPACE_CLASS = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null id: that of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def find_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the
    driver did; elsewhere it is installed or sent with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` of a function on single record batches."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)
    find_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))


def starts_of(keys: np.ndarray) -> np.ndarray:
    """First index of each run of equal values in a sorted array."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def filter_rows(df: DataFrame, text_col: str, keep: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """Rows whose text passes ``keep`` (a mask per column of texts), with all
    their columns, whatever these are called."""
    place = df.columns.index(text_col)

    def run(rows: pa.RecordBatch):
        yield rows.filter(pa.array(keep(rows.column(place))))
    return map_rows(df, run, df.schema)


def join_ids(df: DataFrame, ids: DataFrame, id_col: str, how: str, most: int = 16 << 20) -> DataFrame:
    """Semi- or anti-join with a stored one-column table of ids: broadcast when its
    measured size is at most ``most`` bytes, shuffled otherwise."""
    width = F.octet_length(F.col(id_col)) + 16 if isinstance(ids.schema[id_col].dataType, (T.StringType, T.BinaryType)) else F.lit(16)
    size = ids.agg(F.sum(width)).first()[0] or 0
    return df.join(F.broadcast(ids) if size <= most else ids, id_col, how).select(*df.columns)
