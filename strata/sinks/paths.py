"""Filesystem operations through the Hadoop FileSystem of a path (local, HDFS,
object stores alike)."""
from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def size_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _fs_path(spark, path)
    return int(fs.getContentSummary(p).getLength())


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a folder or file; the parent of ``new`` is made if absent."""
    fs, p = _fs_path(spark, old)
    q = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise OSError(f"cannot move {old} to {new}")


def touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.create(p, True).close()


def folders(spark: SparkSession, path: str, depth: int = 1) -> list[str]:
    """Relative paths of the visible folders ``depth`` levels below ``path``."""
    fs, p = _fs_path(spark, path)
    level = [("", p)]
    for _ in range(depth):
        level = [(f"{rel}/{s.getPath().getName()}".lstrip("/"), s.getPath())
                 for rel, at in level if fs.exists(at)
                 for s in fs.listStatus(at)
                 if s.isDirectory() and ("=" in s.getPath().getName()
                                         or not s.getPath().getName().startswith(("_", ".")))]
    return sorted(rel for rel, _ in level)


def partition_folder(spark: SparkSession, cols, values: dict) -> str:
    """``col=value/...`` as Spark writes it: escaped, NULL and '' as the
    default partition."""
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(utils.getPartitionPathString(c, None if values[c] is None else str(values[c]))
                    for c in cols)
