"""Thin Hadoop FileSystem helpers (exists, rename, list, delete).

All table files live on a Hadoop-compatible filesystem so the same code
runs on local disk, HDFS or an object store.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, s = _fs(spark, src)
    _, d = _fs(spark, dst)
    parent = d.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    return bool(fs.rename(s, d))


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    return bool(fs.delete(p, recursive))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` (empty if it is absent)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def count_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> int:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return 0
    it = fs.listFiles(p, True)
    n = 0
    while it.hasNext():
        if it.next().getPath().getName().endswith(suffix):
            n += 1
    return n


def has_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> bool:
    """Whether any such file lies under ``path``; ends at the first one."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    it = fs.listFiles(p, True)
    while it.hasNext():
        if it.next().getPath().getName().endswith(suffix):
            return True
    return False


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries (files and folders) of ``path``; empty if absent."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, True).close()
