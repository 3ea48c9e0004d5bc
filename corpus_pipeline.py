"""Corpus pipeline: five stages over ``documents``, each one operator.

    toxicity -> near duplicates -> benchmark decontamination -> secrets -> mix

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it
leaves, with their columns: the first three drop rows, the fourth masks live
credentials, the last repeats or leaves out rows so that the sources meet
their target words.  Nulls, empty texts, repeated rows, empty tables and extra
columns are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat.llm import decontamination, mixing, near_duplicates, secret_scan, toxicity
from regiostat.llm.common import crc_mod, table
from regiostat.session import staged_tables, staging_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores below 0.7."""
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"), learn=crc_mod(F.col("doc_id"), 3) != 1)
    return toxicity.reject(docs, machine, 0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts similar in 80 % of their five-word shingles."""
    return near_duplicates.deduplicate(docs, words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words in a row with a benchmark item."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10, k=5)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live credentials masked."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as they are taken."""
    return mixing.mixed(docs, weights=(1, 2, 3), max_copies=3)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", mask_secrets),
    ("mixing", mix_sources),
]

#: A trained machine, sketches and winnowing are no SQL: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written once; what a stage keeps on
    disk meanwhile is deleted when its result is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = staging_path(spark, name.replace(" ", "-"))
        with staged_tables(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
