"""Exact dedup by a tree merge of digest runs, in DataFrame operations only.

Each input partition forms a run of (digest, identifier) records, sorted by digest; equal
texts inside it combine before anything is sent. Runs then merge in rounds, as in a
binomial tree: in round b, the run whose number has bit b set sends its records to the
run without it. There both sorted runs are merged, equal digests meet, and one record
with the winning identifier and the summed count survives. Records are merged by sort and
never by hash: their winner is a struct, which Spark aggregates over sorted rows. A group
of any size sends one record per run and round, whatever its share of the rows.

A merge only unites records that also agree in byte length and in a second, independent
hash. After the last round the texts themselves are compared: of every group of two or
more, the least and the greatest normalised text must be the same bytes (an aggregate
that sends at most two texts per task and group). Should they differ, it raises.

Texts are equal when identical after lower-casing A-Z; null counts as empty.
The row with the largest doc_id stays (``keep="min"`` keeps the smallest).
Rows that repeat a doc_id and text are one document: each is returned, counted
in ``group_size`` and kept or dropped alike. Null ids lose to any id; a group
of null ids only has a null ``keep_id`` and is kept. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LAST_ID, fixed, lower_ascii

KEY = ["digest", "n_bytes", "check"]
RUN_BITS = 8


def digest_records(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, n_bytes, check) of every normalised text."""
    return (docs.select("doc_id", lower_ascii(F.col("text")).alias("norm"))
            .select("doc_id", F.unhex(F.sha2("norm", 256)).alias("digest"),
                    F.octet_length("norm").alias("n_bytes"),
                    F.xxhash64("norm").alias("check")))


def sorted_runs(records: DataFrame, run_bits: int, keep: str) -> DataFrame:
    """The first level: records of an input partition, in its run."""
    last = F.lit(LAST_ID if keep == "min" else -LAST_ID - 1)
    return records.select(
        F.pmod(F.spark_partition_id(), F.lit(1 << run_bits)).alias("run"), *KEY,
        F.struct(F.coalesce("doc_id", last).alias("id"), F.col("doc_id").alias("keep_id"))
        .alias("winner"), F.lit(1).cast("long").alias("group_size"))


def merge_round(runs: DataFrame, bit: int, keep: str) -> DataFrame:
    """Merge every run that has the bit set into the one that has not."""
    best = F.max if keep == "max" else F.min
    into = F.col("run").bitwiseAND(F.lit(~(1 << bit))).alias("run")
    return runs.groupBy(into, *KEY).agg(best("winner").alias("winner"),
                                        F.sum("group_size").alias("group_size"))


def merge_runs(records: DataFrame, run_bits: int = RUN_BITS, keep: str = "max") -> DataFrame:
    """One record per digest: ``keep_id`` and ``group_size``, after a round for every bit."""
    runs = sorted_runs(records, run_bits, keep)
    for bit in range(run_bits):
        runs = merge_round(runs, bit, keep)
    return runs.select(*KEY, "winner.keep_id", "group_size")


def unequal_groups(docs: DataFrame, merged: DataFrame) -> DataFrame:
    """Digests of groups whose texts are not all the same bytes."""
    norm = lower_ascii(F.col("text"))
    members = docs.select(norm.alias("norm")).select(
        F.unhex(F.sha2("norm", 256)).alias("digest"), "norm").join(
        merged.filter("group_size > 1").select("digest"), "digest", "leftsemi")
    return (members.groupBy("digest").agg(F.min("norm").alias("low"), F.max("norm").alias("high"))
            .filter("low != high").select("digest"))


def exact_dedup(docs: DataFrame, run_bits: int = RUN_BITS, keep: str = "max") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    records = fixed(digest_records(docs))
    merged = fixed(merge_runs(records, run_bits, keep))
    if not unequal_groups(docs, merged).isEmpty():
        raise ValueError("different texts share a SHA-256 digest")
    return records.join(merged, KEY).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
