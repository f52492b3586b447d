"""Session helpers: a tuned local/cluster session and a shared scratch area.

Intermediate tables (fitted label tables, staged copies for the file-format
checks) are written under the folder the cluster names in
``spark.checkpoint.dir``. That folder is shared storage on a cluster, so the
written tables survive the loss of any executor. A folder of our own is set
only when the session has none (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SCRATCH_SUBDIR = "farpoint-scratch"
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# HotSpot does not JIT-compile methods over 8000 bytes of bytecode. Spark's
# documentation recommends this value for spark.sql.codegen.hugeMethodLimit
# on HotSpot: a whole-stage-codegen stage whose method would be larger falls
# back to per-expression codegen, which splits wide expressions (such as a
# nearest-centre distance over many centres) into methods the JIT compiles.
# Measured on the k=10 distance filter: 7x faster than the interpreted method.
HOTSPOT_METHOD_LIMIT = 8000
_SPARK_DEFAULT_METHOD_LIMIT = "65535"


def build_session(master: str | None = None, app_name: str = "farpoint",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings this library relies on.

    AQE stays on: it coalesces the small shuffles of the statistics jobs and
    splits skewed partitions of the shuffle joins used for large label sets.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.codegen.hugeMethodLimit": str(HOTSPOT_METHOD_LIMIT),
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def tune_codegen(spark: SparkSession) -> None:
    """Apply the HotSpot method limit unless the session set its own value."""
    current = spark.conf.get("spark.sql.codegen.hugeMethodLimit", _SPARK_DEFAULT_METHOD_LIMIT)
    if current == _SPARK_DEFAULT_METHOD_LIMIT:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(HOTSPOT_METHOD_LIMIT))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        # A folder of this machine is no use to other machines' executors.
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="farpoint-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{_SCRATCH_SUBDIR}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet to the shared scratch area and read it back.

    Cuts lineage: later jobs read the written table instead of recomputing the
    plan (which may contain a full scan), and the values are fixed even when
    the plan holds non-deterministic parts such as partition ids.
    """
    return materialise_at(df, name)[0]


def materialise_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``materialise`` that also returns the written path (for ``drop_path``)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), path


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside drop their shuffle files as they end.

    For results that are written: nothing reads those files again. Else they stay until
    the driver's garbage collector happens upon what owns them.
    """
    old = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP_SHUFFLES, old)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table this library wrote, through Hadoop's FileSystem API
    (works for the shared store the checkpoint folder lives on)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(hpath, True)


def default_parallelism(spark: SparkSession) -> int:
    try:
        return max(1, int(spark.sparkContext.defaultParallelism))
    except Exception:  # pragma: no cover - defensive
        return max(1, os.cpu_count() or 1)


def list_files(spark: SparkSession, path: str) -> set[str]:
    """Data files directly under ``path`` (empty if it does not exist)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return set()
    out = set()
    for status in fs.listStatus(hpath):
        name = status.getPath().getName()
        if status.isFile() and not name.startswith(("_", ".")):
            out.add(status.getPath().toString())
    return out
