"""Small text files on whatever file system Spark uses (local, HDFS, object store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def list_files(spark: SparkSession, folder: str, suffix: str = "") -> list[str]:
    fs, path, _ = _fs(spark, folder)
    if not fs.exists(path):
        return []
    found = [str(s.getPath().toString()) for s in fs.listStatus(path) if s.isFile()]
    return [f for f in found if f.endswith(suffix) and not f.endswith(".crc")]


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def write_text(spark: SparkSession, files: dict[str, str], folder: str, remove: bool) -> None:
    fs, path, jvm = _fs(spark, folder)
    if remove and fs.exists(path):
        fs.delete(path, True)
    fs.mkdirs(path)
    for name, text in files.items():
        out = fs.create(jvm.org.apache.hadoop.fs.Path(name), True)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
