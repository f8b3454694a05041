"""Folders of Spark's file systems: what has to be there, moved or gone around a write."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """A path and the file system that holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.makeQualified(target), files


def exists(spark: SparkSession, path: str) -> bool:
    target, files = file_system(spark, path)
    return files.exists(target)


def make_folder(spark: SparkSession, path: str) -> None:
    target, files = file_system(spark, path)
    files.mkdirs(target)


def delete_folder(spark: SparkSession, path: str) -> None:
    target, files = file_system(spark, path)
    files.delete(target, True)


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put ``source`` in the place of ``target``; without ``source`` the place is empty afterwards."""
    delete_folder(spark, target)
    old, files = file_system(spark, source)
    if files.exists(old):
        new = file_system(spark, target)[0]
        files.mkdirs(new.getParent())
        if not files.rename(old, new):
            raise OSError(f"{source} could not be moved to {target}")


def swap_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put ``source`` in the place of ``target``, which goes last; if the move fails, ``target`` comes back."""
    new, files = file_system(spark, source)
    place = file_system(spark, target)[0]
    aside = file_system(spark, f"{target.rstrip('/')}-replaced-{uuid.uuid4().hex}")[0]
    held = files.exists(place)
    if held and not files.rename(place, aside):
        raise OSError(f"{target} could not be moved aside")
    if not files.rename(new, place):
        if held:
            files.rename(aside, place)
        raise OSError(f"{source} could not be moved to {target}")
    if held:
        files.delete(aside, True)


def files_of(spark: SparkSession, path: str) -> list[str]:
    """The part files of a folder that this package has written."""
    target, files = file_system(spark, path)
    return [f.getPath().toString() for f in files.listStatus(target) if f.getPath().getName().startswith("part-")]
