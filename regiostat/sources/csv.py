"""CSV datasets (S3): dialect and encoding from the manifest, text columns.

Nothing is inferred: every column is read as text under its header name and
typed later from the manifest (P3).  Files are split between tasks unless the
dataset has line breaks inside quotes (``multi_line``); ``escape='"'`` reads
doubled quotes; Spark drops a UTF-8 BOM.  Encodings go by their Python names:
single-byte ones that Spark does not read are read as ISO-8859-1 and their
upper half is translated.
"""

from __future__ import annotations

import codecs
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# CSV dialect defaults.
DEFAULT_DELIMITER = ","
DEFAULT_DOUBLE_QUOTE = True
DEFAULT_ENCODING = "utf-8"
#: Codecs (by Python's own name) that Spark reads itself.
SPARK_CHARSETS = {"utf-8": "UTF-8", "utf-8-sig": "UTF-8", "ascii": "US-ASCII", "iso8859-1": "ISO-8859-1",
                  "utf-16": "UTF-16", "utf-16-le": "UTF-16LE", "utf-16-be": "UTF-16BE"}


def charset(encoding: str | None) -> tuple[str, tuple[str, str] | None]:
    """``(Spark charset, characters to translate)`` of a Python encoding name."""
    name = codecs.lookup((encoding or DEFAULT_ENCODING).strip()).name
    if name in SPARK_CHARSETS:
        return SPARK_CHARSETS[name], None
    pairs = []
    for b in range(256):
        char = bytes([b]).decode(name, errors="replace")
        if len(char) != 1 or (b < 128 and char != chr(b)):
            raise ValueError(f"encoding {encoding!r} is no single-byte extension of ASCII")
        if char != chr(b):
            pairs.append((chr(b), char))
    return "ISO-8859-1", ("".join(a for a, _ in pairs), "".join(b for _, b in pairs))


def has_broken_lines(spark: SparkSession, path: str, encoding: str | None = None) -> bool:
    """Whether some line has an odd number of quotes, i.e. a quoted value
    goes on in the next one (a split scan that stops at the first)."""
    lines = spark.read.option("encoding", charset(encoding)[0]).text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not lines.filter(quotes % 2 == 1).isEmpty()


def read_csv_dataset(spark: SparkSession, path: str, delimiter: str | None = None, double_quote: bool | None = None,
                     encoding: str | None = None, multi_line: bool = False) -> DataFrame:
    enc, upper_half = charset(encoding)
    dq = DEFAULT_DOUBLE_QUOTE if double_quote is None else double_quote
    df = (spark.read.option("header", True).option("inferSchema", False)
          .option("sep", delimiter or DEFAULT_DELIMITER).option("quote", '"')
          .option("escape", '"' if dq else "\\").option("multiLine", multi_line).option("encoding", enc)
          .option("mode", "PERMISSIVE").csv(path))
    if upper_half is None:
        return df
    table = str.maketrans(*upper_half)
    return df.select(*[F.translate(F.col(f"`{c}`"), *upper_half).alias(c.translate(table)) for c in df.columns])


def write_csv_dataset(df: DataFrame, path: str, delimiter: str = DEFAULT_DELIMITER) -> None:
    """Stage a text table as CSV with a header (used to build file inputs)."""
    (df.write.mode("overwrite").option("header", True).option("sep", delimiter)
     .option("quote", '"').option("escape", '"').csv(path))


def write_packed_files(files: DataFrame, path: str) -> None:
    """Stage small text files, rows ``file, content``, as one table: it takes as
    many files as it has bytes for, not one (and a folder) for every row."""
    files.select("file", "content").write.parquet(path)


def file_headers(spark: SparkSession, path: str, delimiter: str = ",", packed: bool = False) -> DataFrame:
    """``file, fields``: the column names in the first line of every file below
    ``path`` (quoted names may hold the delimiter), or of every file in the table
    of packed ones at ``path``.  Empty files have no first line and are left out."""
    first = _packed_first_lines(spark, path) if packed else _first_lines(spark, path)
    names = F.split(F.regexp_replace("line", "[\\uFEFF\\r]", ""), re.escape(delimiter) + r'(?=(?:[^"]*"[^"]*")*[^"]*$)')
    plain = F.transform(names, lambda n: F.when(n.startswith('"') & n.endswith('"'), F.replace(F.substring(n, F.lit(2), F.length(n) - 2), F.lit('""'), F.lit('"'))).otherwise(n))
    return first.select("file", plain.alias("fields"))


def _first_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value", F.monotonically_increasing_id().alias("n"))
    return lines.filter("at = 0").groupBy("file").agg(F.min_by("value", "n").alias("line"))


def _packed_first_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter("content != ''").select("file", F.substring_index("content", "\n", 1).alias("line"))
