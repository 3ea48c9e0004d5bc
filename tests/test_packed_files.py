"""Small files stored packed: their headers, and how many files they take."""

import os

from pyspark.sql import functions as F

from regiostat import session
from regiostat.plans.registry import QUERIES, load_all
from regiostat.sources.csv import file_headers, write_packed_files


def test_packed_headers_equal_those_of_files(spark, tmp_path):
    texts = {"a.csv": "x;y\n1;2\n", "b.csv": '\ufeff"x;old";"say ""y""";z\r\n1;2;3', "c.csv": "only", "d.csv": "", "e.csv": "\nlate;1", "f.csv": "x;\n;"}
    (tmp_path / "plain").mkdir()
    for name, text in texts.items():
        (tmp_path / "plain" / name).write_bytes(text.encode())
    write_packed_files(spark.createDataFrame(list(texts.items()), "file string, content string"), str(tmp_path / "packed"))
    plain = {os.path.basename(r.file): r.fields for r in file_headers(spark, str(tmp_path / "plain"), ";").collect()}
    packed = {r.file: r.fields for r in file_headers(spark, str(tmp_path / "packed"), ";", packed=True).collect()}
    assert packed == plain and packed["b.csv"] == ["x;old", 'say "y"', "z"] and "d.csv" not in packed


def test_schema_difference_stages_fewer_files_than_packages(spark, tmp_path):
    load_all()
    spark.range(2000).select(F.col("id").alias("p_partkey")).write.parquet(f"{tmp_path}/part.parquet")
    mark = len(session._STAGED)
    found = {(r.package, r.field) for r in QUERIES["schema_difference"](spark, str(tmp_path)).collect()}
    staged = next(p for p in session._STAGED[mark:] if "package_files" in p)
    assert sum(len(files) for _, _, files in os.walk(staged)) < 50  # 500 packages
    tabular = [k for k in range(2, 2000, 4) if k % 37]
    assert found == {(f"pkg{k}", "value") for k in tabular if k % 5 == 0} | {(f"pkg{k}", "nuts_id") for k in tabular if k % 6 == 0}
