"""Moving, listing and removing what was written, in whatever file system the path names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """The path's file system, and the path as it takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, in order; none where there is no such folder."""
    files, place = _at(spark, path)
    return sorted(entry.getPath().getName() for entry in files.listStatus(place)) if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """A folder with all it holds; nothing where it is not there."""
    files, place = _at(spark, path)
    files.delete(place, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename ``source`` to ``target``, which must not be there."""
    files, place = _at(spark, source)
    _, wanted = _at(spark, target)
    files.mkdirs(wanted.getParent())
    if files.exists(wanted) or not files.rename(place, wanted):
        raise OSError(f"cannot move {source} to {target}")


def swap_in(spark: SparkSession, staged: str, target: str) -> None:
    """Put ``staged`` in the place of ``target``; what was there goes last, and comes back if that fails."""
    if not exists(spark, target):
        move(spark, staged, target)
        return
    aside = aside_of(target, "old")
    move(spark, target, aside)
    try:
        move(spark, staged, target)
    except Exception:
        move(spark, aside, target)
        raise
    remove(spark, aside)


def add_files(spark: SparkSession, staged: str, target: str) -> None:
    """Move each file of ``staged`` to the same place below ``target``; writers give files names of their own."""
    files, place = _at(spark, staged)
    root = files.makeQualified(place).toString().rstrip("/")
    found, paths = files.listFiles(place, True), []
    while found.hasNext():
        paths.append(found.next().getPath().toString())
    for path in paths:
        if not path.rsplit("/", 1)[1].startswith(("_", ".")):
            move(spark, path, f"{target.rstrip('/')}{path[len(root):]}")
    remove(spark, staged)


def aside_of(path: str, label: str) -> str:
    """A new hidden folder beside ``path``, in the same file system, which readers of its parent pass over."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}-{label}-{uuid.uuid4().hex}"
