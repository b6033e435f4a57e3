"""Folder questions answered by the session's Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return target.getFileSystem(conf), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when the folder holds anything but hidden entries."""
    fs, target = _open(spark, path)
    return fs.exists(target) and any(
        not entry.getPath().getName().startswith(("_", ".")) for entry in fs.listStatus(target)
    )


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible folders directly below ``path``."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    names = [e.getPath().getName() for e in fs.listStatus(target) if e.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def any_like(spark: SparkSession, pattern: str) -> bool:
    """Whether a path fits ``pattern``."""
    fs, target = _open(spark, pattern)
    return bool(fs.globStatus(target))


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.mkdirs(target)


def make_file(spark: SparkSession, path: str) -> None:
    """An empty file, also where there is one."""
    fs, target = _open(spark, path)
    fs.create(target, True).close()


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    fs, source_path = _open(spark, source)
    if not fs.rename(source_path, _open(spark, target)[1]):
        raise OSError(f"cannot move {source} to {target}")
