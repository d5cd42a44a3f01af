"""Small helpers over the Hadoop file system, so any store Spark can read works."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    handle = jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), handle


def exists(spark: SparkSession, path: str) -> bool:
    fs, handle = _path(spark, path)
    return fs.exists(handle)


def delete(spark: SparkSession, path: str) -> None:
    fs, handle = _path(spark, path)
    fs.delete(handle, True)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes below `path`."""
    fs, handle = _path(spark, path)
    return fs.getContentSummary(handle).getLength()


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Names, sizes and times of all files below `paths`, as one hash; missing paths count as empty."""
    seen = []
    for path in paths:
        fs, handle = _path(spark, path)
        found = fs.listFiles(handle, True) if fs.exists(handle) else None
        while found is not None and found.hasNext():
            s = found.next()
            seen.append((str(s.getPath()), s.getLen(), s.getModificationTime()))
    return hashlib.md5(repr(sorted(seen)).encode()).hexdigest()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a glob pattern finds."""
    fs, handle = _path(spark, pattern)
    return [str(s.getPath()) for s in fs.globStatus(handle) or []]


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, handle = _path(spark, source)
    _, goal = _path(spark, target)
    if goal.getParent() is not None:
        fs.mkdirs(goal.getParent())
    if not fs.rename(handle, goal):
        raise OSError(f"could not move {source} to {target}")


def copy(spark: SparkSession, source: str, target: str) -> None:
    fs, handle = _path(spark, source)
    to_fs, goal = _path(spark, target)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    if not jvm.org.apache.hadoop.fs.FileUtil.copy(fs, handle, to_fs, goal, False, True, conf):
        raise OSError(f"could not copy {source} to {target}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """Text of a small file, or None when it does not exist. A replacement that a lost driver
    left complete beside it (see write_text) counts while the file itself is gone."""
    fs, handle = _path(spark, path)
    if not fs.exists(handle):
        _, handle = _path(spark, f"{path}.new")
        if not fs.exists(handle):
            return None
    stream = fs.open(handle)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file. `.new` only ever holds a complete text, so at every moment either the
    file or `.new` can be read."""
    fs, handle = _path(spark, path)
    _, side = _path(spark, f"{path}.new")
    _, draft = _path(spark, f"{path}.draft")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(handle):
        fs.delete(side, False)  # left by a lost run, and older than the file
    elif fs.exists(side):
        fs.rename(side, handle)
    if not fs.rename(draft, side):
        raise OSError(f"could not write {path}")
    fs.delete(handle, False)
    if not fs.rename(side, handle):
        raise OSError(f"could not write {path}")


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file, complete from the moment it can be seen; fails if it is there already."""
    fs, handle = _path(spark, path)
    _, draft = _path(spark, f"{path}.draft")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(handle) or not fs.rename(draft, handle):
        raise FileExistsError(f"{path} was written by someone else")


def to_json(value: object) -> str:
    return json.dumps(value, indent=2, default=str)


def from_json(text: str | None) -> object:
    return None if text is None else json.loads(text)
