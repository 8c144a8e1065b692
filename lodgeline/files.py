"""Questions about paths, asked of the file system that holds them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _status(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getFileStatus(target) if system.exists(target) else None


def exists(spark: SparkSession, path: str) -> bool:
    return _status(spark, path) is not None


def swap(spark: SparkSession, new: str, name: str) -> None:
    """Put folder `new` in the place of folder `name`, by renaming.

    The old folder stands beside it under `name`__old until the new one is in place, so a crash loses neither.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    target, old = path(name), path(f"{name.rstrip('/')}__old")
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(old, True)
    for source, place in ((target, old), (path(new), target)):
        if not system.rename(source, place):
            raise OSError(f"cannot rename {source} to {place}")
    system.delete(old, True)
    spark.catalog.refreshByPath(name)


def is_file(spark: SparkSession, path: str) -> bool:
    status = _status(spark, path)
    return status is not None and status.isFile()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def replace_folder(spark: SparkSession, staging: str, root: str, folder: str) -> None:
    """Put `staging`/`folder` in the place of `root`/`folder`, which stands under `root`__old meanwhile."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    target, old = path(f"{root}/{folder}"), path(f"{root}__old/{folder}")
    system.mkdirs(old.getParent())
    if system.exists(target) and not system.rename(target, old):
        raise OSError(f"cannot rename {target} to {old}")
    if not system.rename(path(f"{staging}/{folder}"), target):
        raise OSError(f"cannot rename {staging}/{folder} to {target}")
    system.delete(old, True)


def restore_folders(spark: SparkSession, root: str) -> None:
    """Undo what a crash has left of `replace_folder`: folders aside go back, unless a new one is in their place."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in children(spark, f"{root}__old"):
        target, old = path(f"{root}/{folder}"), path(f"{root}__old/{folder}")
        if not system.exists(target) and not system.rename(old, target):
            raise OSError(f"cannot rename {old} to {target}")
        system.delete(old, True)
