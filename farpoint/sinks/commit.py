"""Text output that a replay leaves as it is (K1, K3).

Appending part files twice doubles the lines. Here the lines of one commit id (a
micro-batch's epoch, a job's run) are written once, in three steps:

1. part files are written to a staging folder that no reader looks at;
2. they are renamed to names made from the commit id, after deleting what an earlier
   attempt of the same commit may have left under such names;
3. a manifest that lists them is published by a rename: that is the commit.

A commit with a manifest is never written again. One that stopped before is written anew,
to the same names. ``committed_lines`` reads what manifests list, so it never shows part
of a commit; ``spark.read.text(path)`` sees the same lines once the commit is done. One
writer at a time may use a commit id.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from .. import storage

LOG, STAGING = "_commits", "_staging"


def _checked_id(commit: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", commit) or "--" in commit:
        raise ValueError(f"bad commit id {commit!r}: letters, digits, '_', '.' and single "
                         "'-' only")
    return commit


def is_committed(spark: SparkSession, path: str, commit: str) -> bool:
    return storage.exists(spark, f"{path.rstrip('/')}/{LOG}/{_checked_id(commit)}.json")


def commit_text(lines: DataFrame, path: str, commit: str) -> list[str]:
    """Write ``lines`` (one string column) under ``path`` once per commit id; the files."""
    spark, path = lines.sparkSession, path.rstrip("/")
    manifest = f"{path}/{LOG}/{_checked_id(commit)}.json"
    if storage.exists(spark, manifest):
        return [f"{path}/{name}" for name in storage.read_json(spark, manifest)["files"]]
    prefix = f"part-{commit}--"
    for left in storage.names(spark, path):
        if left.startswith(prefix):
            storage.remove(spark, f"{path}/{left}")
    staged = f"{path}/{STAGING}/{commit}-{uuid.uuid4().hex}"
    lines.write.text(staged)
    files = []
    for name in storage.names(spark, staged):
        if name.startswith("part-"):
            files.append(f"{prefix}{len(files):05d}.txt")
            storage.rename(spark, f"{staged}/{name}", f"{path}/{files[-1]}")
    storage.publish_json(spark, manifest, {"commit": commit, "files": files})
    storage.remove(spark, staged)
    return [f"{path}/{name}" for name in files]


def committed_files(spark: SparkSession, path: str) -> list[str]:
    """Files of all commits under ``path``."""
    path = path.rstrip("/")
    found = [storage.read_json(spark, f"{path}/{LOG}/{name}")["files"]
             for name in storage.names(spark, f"{path}/{LOG}") if name.endswith(".json")
             and not name.startswith("_")]
    return [f"{path}/{name}" for files in found for name in files]


def committed_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all commits under ``path``."""
    files = committed_files(spark, path)
    return spark.read.text(files) if files else spark.createDataFrame([], "value string")
