"""Files through the Hadoop FileSystem of their path: local disk, HDFS and object stores alike."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder; [] where there is no such folder."""
    fs, p = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since the epoch of the last change."""
    fs, p = _open(spark, path)
    return fs.getFileStatus(p).getModificationTime() / 1000


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _open(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not exist; False when it does."""
    fs, p = _open(spark, path)
    if fs.exists(p):
        return False
    try:
        stream = fs.create(p, False)
    except Exception as e:
        if "FileAlreadyExists" in str(e):           # another writer was first
            return False
        raise
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    return True


def remove(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.delete(p, True)
