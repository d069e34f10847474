"""Small metadata files on the store that holds the tables (Hadoop file system API).

Spark writes and reads all data.  What this module handles are a few files of some
hundred bytes: pointers to the current version of a table set, and claims.  Data files it
only moves.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _is_missing(err: Py4JJavaError) -> bool:
    return "FileNotFoundException" in str(err.java_exception.getClass().getName())


def listed(spark: SparkSession, path: str) -> dict[str, float]:
    """Names in a folder, hidden ones aside, with when they changed (seconds); none if it is absent."""
    fs, where = _at(spark, path)
    try:
        found = {s.getPath().getName(): s.getModificationTime() / 1000 for s in fs.listStatus(where)}
    except Py4JJavaError as err:
        if not _is_missing(err):
            raise
        return {}
    return {name: at for name, at in found.items() if not name.startswith((".", "_"))}


def put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that appears whole or not at all."""
    folder, name = path.rsplit("/", 1)
    fs, where = _at(spark, path)
    _, draft = _at(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(draft, where):
        raise OSError(f"{path} could not be put in place")


def get(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if it is gone."""
    fs, where = _at(spark, path)
    try:
        source = fs.open(where)
    except Py4JJavaError as err:
        if not _is_missing(err):
            raise
        return None
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens if it is gone already."""
    fs, where = _at(spark, path)
    fs.delete(where, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder and those above it; nothing happens if it is there already."""
    fs, where = _at(spark, path)
    fs.mkdirs(where)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a file or folder another place on its store, in a folder that is there."""
    fs, where = _at(spark, source)
    try:
        done = fs.rename(where, _at(spark, target)[1])
    except Py4JJavaError as err:  # some stores raise where others say no
        if not _is_missing(err):
            raise
        done = False
    if not done:
        raise OSError(f"{source} could not be moved to {target}")


def now(spark: SparkSession, folder: str) -> float:
    """The store's own time in seconds: that of a file written just now."""
    path = f"{folder}/.clock.{uuid.uuid4().hex}"
    fs, where = _at(spark, path)
    fs.create(where, False).close()
    try:
        return fs.getFileStatus(where).getModificationTime() / 1000
    finally:
        fs.delete(where, False)
