"""Label indexing for string features, sized for any label cardinality.

Order rule (same as MLlib's ``StringIndexer`` default ``frequencyDesc``): the
most frequent label gets index 0; equal counts are ordered alphabetically.

Three tiers, chosen from an exact, size-checked label count:

* up to ``INLINE_LABELS`` labels per column (the usual case: segments, event
  types, genders): a literal map lookup inside the projection - no join, no
  broadcast job, stays in whole-stage codegen;
* up to the caller's local bound: ranked on the driver from the aggregated
  table and joined back with a broadcast hash join;
* beyond: never on the driver - ranked with a distributed sort plus
  per-partition offsets and joined with a shuffle join, where AQE splits a
  hot label's partition.

All three drop rows with a null or unknown label, like "skip".
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import drop_path, materialise_at

# Largest label set per column inlined as a literal map in the projection
# (by count and by total UTF-8 size, which bounds the plan's size).
INLINE_LABELS = 32
INLINE_LABEL_BYTES = 8 * 1024


@dataclass
class LabelTable:
    """Fitted label → index mapping for one string column."""

    column: str
    frame: DataFrame | None   # columns: <label_col> string, <index_col> double
    label_col: str
    index_col: str
    size: int             # number of labels
    local: bool           # small enough to broadcast (size was checked)
    mean: float           # mean of the index over the kept rows
    std: float            # sample std of the index over the kept rows
    mapping: dict[str, float] | None = None   # set for inline-sized tables
    path: str | None = None   # of a table that was written for this mapping

    def join_onto(self, df: DataFrame) -> DataFrame:
        """Add the index column; rows with a null or unknown label are skipped."""
        if self.mapping is not None:
            if not self.mapping:
                return df.where(F.lit(False)).withColumn(self.index_col,
                                                         F.lit(None).cast("double"))
            lookup = F.create_map(*[x for k, v in self.mapping.items()
                                    for x in (F.lit(k), F.lit(v))])
            # filtered by the labels themselves, so the map is only read for kept rows
            known = df.where(F.col(self.column).isin(*self.mapping))
            return known.withColumn(self.index_col, F.try_element_at(lookup, F.col(self.column)))
        right = F.broadcast(self.frame) if self.local else self.frame
        joined = df.join(right, df[self.column] == right[self.label_col], "inner")
        return joined.drop(self.label_col)


def weighted_mean_std(pairs: list[tuple[float, int]]) -> tuple[float, float]:
    """Mean and sample std of values given as (value, count) pairs."""
    n = sum(c for _, c in pairs)
    if n == 0:
        return 0.0, 0.0
    mean = math.fsum(v * c for v, c in pairs) / n
    if n < 2:
        return mean, 0.0
    ss = math.fsum(c * (v - mean) ** 2 for v, c in pairs)
    return mean, math.sqrt(ss / (n - 1))


def local_label_tables(spark: SparkSession, columns: list[str],
                       rows: list[tuple[int, str, int, int]],
                       label_cols: list[str], index_cols: list[str]) -> list[LabelTable]:
    """Build label tables from a small, already size-checked count table.

    ``rows`` holds (position, label, n_fit, n_kept): position is 1-based over
    ``columns``; n_fit is the label count used for ordering, n_kept the count
    over rows that survive every null skip (used for the index's spread).
    """
    tables = []
    for pos, name in enumerate(columns, 1):
        mine = [r for r in rows if r[0] == pos]
        mine.sort(key=lambda r: (-r[2], r[1]))
        data = [(r[1], float(i)) for i, r in enumerate(mine)]
        mean, std = weighted_mean_std([(float(i), r[3]) for i, r in enumerate(mine)])
        if (len(data) <= INLINE_LABELS
                and sum(len(lbl.encode("utf-8")) for lbl, _ in data) <= INLINE_LABEL_BYTES):
            tables.append(LabelTable(name, None, label_cols[pos - 1], index_cols[pos - 1],
                                     len(data), True, mean, std, dict(data)))
            continue
        schema = f"`{label_cols[pos - 1]}` string, `{index_cols[pos - 1]}` double"
        frame = spark.createDataFrame(data, schema)
        tables.append(LabelTable(name, frame, label_cols[pos - 1], index_cols[pos - 1],
                                 len(data), True, mean, std))
    return tables


def rank_distributed(counts: DataFrame) -> tuple[DataFrame, str]:
    """Rank labels per position without one task holding a whole column.

    ``counts`` has (pos, label, n_fit, n_kept). Returns the same plus ``idx``
    (0-based rank by n_fit desc, label asc within pos). A range-partitioned
    sort spreads the labels; each row's rank is its partition's offset (sum of
    the sizes of earlier partitions for the same pos: a table with one row per
    partition and position, so bounded by the shuffle width) plus its position
    inside the partition. The tagged table is written out so the partition ids
    stay fixed if a task is retried; its path is returned for clean-up once
    the ranked result has been written.
    """
    ordered = counts.orderBy("pos", F.desc("n_fit"), "label")
    tagged, tagged_path = materialise_at(
        ordered.select("*", F.spark_partition_id().alias("_pid"),
                       F.monotonically_increasing_id().alias("_mid")),
        "label-rank")
    blocks = tagged.groupBy("pos", "_pid").agg(
        F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("pos").orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    blocks = blocks.select("pos", "_pid", "_first",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    ranked = (tagged.join(F.broadcast(blocks), ["pos", "_pid"])
              .select("pos", "label", "n_fit", "n_kept",
                      (F.col("_off") + F.col("_mid") - F.col("_first")).cast("double")
                      .alias("idx")))
    return ranked, tagged_path


def distributed_label_tables(counts: DataFrame, columns: list[str],
                             label_cols: list[str], index_cols: list[str]) -> list[LabelTable]:
    """Label tables for large label sets; nothing label-sized is collected.

    The ranked table stays in the shared folder: it is the fitted state the
    model joins against (like a saved model); the intermediate tagged table
    is deleted once the ranked one is written.
    """
    spark = counts.sparkSession
    lazy_ranked, tagged_path = rank_distributed(counts)
    ranked, ranked_path = materialise_at(lazy_ranked, "label-index")
    drop_path(spark, tagged_path)
    # Spread of each index column, weighted by kept counts (two small passes
    # over the label table, one row per string column collected each time).
    means = {r["pos"]: (r["n"], r["m"]) for r in ranked.groupBy("pos").agg(
        F.sum("n_kept").alias("n"),
        (F.sum(F.col("n_kept") * F.col("idx")) / F.sum("n_kept")).alias("m")).collect()}
    mean_col = F.create_map(*[x for p, (_, m) in means.items()
                              for x in (F.lit(p), F.lit(m if m is not None else 0.0))])
    ss = {r["pos"]: r["ss"] for r in ranked.groupBy("pos").agg(
        F.sum(F.col("n_kept") * (F.col("idx") - mean_col[F.col("pos")]) ** 2).alias("ss")).collect()}
    sizes = {r["pos"]: r["c"] for r in ranked.groupBy("pos").agg(F.count(F.lit(1)).alias("c")).collect()}
    tables = []
    for pos, name in enumerate(columns, 1):
        n, m = means.get(pos, (0, 0.0))
        n = n or 0
        std = math.sqrt(ss.get(pos, 0.0) / (n - 1)) if n and n > 1 else 0.0
        frame = ranked.where(F.col("pos") == pos).select(
            F.col("label").alias(label_cols[pos - 1]), F.col("idx").alias(index_cols[pos - 1]))
        tables.append(LabelTable(name, frame, label_cols[pos - 1], index_cols[pos - 1],
                                 int(sizes.get(pos, 0)), False, float(m or 0.0), std,
                                 path=ranked_path))
    return tables
