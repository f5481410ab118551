"""File-system checks through Hadoop's FileSystem, so shared folders on HDFS or
object stores work the same as local paths."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    f, p = _fs(spark, path)
    return bool(f.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    f, p = _fs(spark, path)
    if not f.exists(p):
        return []
    return [s.getPath().getName() for s in f.listStatus(p)]


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file appear at `path` in one step (written aside, then renamed); False if the name is taken."""
    jvm = spark.sparkContext._jvm
    aside = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    f, tmp = _fs(spark, aside)
    out = f.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    done = jvm.org.apache.hadoop.fs.Path(path)
    if not f.exists(done) and f.rename(tmp, done):
        return True
    f.delete(tmp, False)
    return False


def read_text(spark: SparkSession, path: str) -> str:
    f, p = _fs(spark, path)
    src = f.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(src)).decode()
    finally:
        src.close()
