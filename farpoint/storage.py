"""Small file operations on the shared store, through Hadoop's FileSystem API.

Works for whatever store a path names (HDFS, object stores, local folders in tests).
Publishing is a rename: on HDFS and local folders it is atomic, so a reader sees all of a
published folder or file, or nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder, sorted; none if there is no such folder."""
    fs, at = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)


def rename(spark: SparkSession, old: str, new: str) -> bool:
    """Move a file or folder to a name that is free; False if it is taken."""
    fs, source = _at(spark, old)
    target = _at(spark, new)[1]
    fs.mkdirs(target.getParent())
    return not fs.exists(target) and fs.rename(source, target)


def write_json(spark: SparkSession, path: str, value) -> None:
    fs, at = _at(spark, path)
    out = fs.create(at, False)
    try:
        out.write(bytearray(json.dumps(value, ensure_ascii=False).encode()))
    finally:
        out.close()


def read_json(spark: SparkSession, path: str):
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def publish_json(spark: SparkSession, path: str, value) -> bool:
    """Write a JSON file so that it is there whole or not at all; False if it was there."""
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/_draft-{name}-{uuid.uuid4().hex}"
    write_json(spark, draft, value)
    if rename(spark, draft, path):
        return True
    remove(spark, draft)
    return False
