"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import re
import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir

WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"
WORD = re.compile("[^\x20\x09-\x0d]+")
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER_ASCII = str.maketrans(UPPER, LOWER)
# Null ids sort after every real id.
LAST_ID = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of results that nothing holds any more.

    It acts on what the driver's garbage collector finds, which may else come late.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; a null text is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def per_batch(docs: DataFrame, schema: str | StructType,
              make: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]]
              ) -> DataFrame:
    """``mapInArrow`` whose per-task state is built by ``make`` inside the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)
    return docs.mapInArrow(run, schema)


def kept_in_worker(key: tuple, make: Callable):
    """What ``make`` builds, kept by this Python process for its later tasks.

    Only for tables and bounded caches that are the same for every task: results
    never depend on whether an earlier task of this process left them behind.
    """
    held = sys.__dict__.setdefault("_farpoint_held", {})
    if key not in held:
        held[key] = make()
    return held[key]


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The batch's texts as Python strings, null as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def with_row(docs: DataFrame, *more: Column) -> DataFrame:
    """The whole input row in one struct ``row``, next to working columns.

    Working columns can then have any name: no column of the input clashes.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *more)
