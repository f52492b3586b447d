"""Mixing sources to target weights on a low-discrepancy schedule.

A source's documents are shuffled (by a hash of their ids) into one stream of
words and cut into blocks of equal length. Slot ``n`` of the schedule maps the
golden-ratio point frac((n + 1) / phi) through the sources' cumulative shares,
which names the slot's source; the slots of a source are ranked, and rank r
takes block r mod (number of blocks). So each stretch of the schedule holds the
sources in their target proportions, and a source is read through once before any
of its blocks comes again. A source's last slot is cut where its target is met.

What a document gives to each slot (``slot_pieces``) is the result: ``taken`` sums those
pieces, and the mix itself is written in the order of its slots, every stretch of
``STRETCH`` slots in one partition. So a prefix of the mix has the targets' proportions.

Targets: the mix holds ``share`` times all words; sources weigh ``weights`` in
turn, by code point with null last; no target exceeds ``most`` times its source,
and what is above is shared among the others by weight until none is above.

The recipe holds one row per source and is gathered on the driver; more than
``MAX_SOURCES`` sources raise an error. Everything that grows with documents or
slots stays distributed: a source's stream is laid out in up to 4096 hash ranges
whose word counts are summed first, and slots are ranked within chunks of 65536,
so a source with a third of all rows is never one task's.

Null and blank texts have size 0 and are never taken. Equal ids are told apart by
text; rows equal in both lie next to each other. Null ids are shuffled by text.
Empty tables give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LAST_ID, WORD_PATTERN, fixed, per_batch, with_row

SHARE, WEIGHTS, MOST = 1.5, (3, 1, 2), 2
BLOCK_WORDS = 4096
SEED = 7
MAX_SOURCES = 100_000
CHUNK = 1 << 16
GOLDEN = (5 ** 0.5 - 1) / 2
STRETCH = 1024


def targets(sizes: list[int], share: float = SHARE, weights: tuple = WEIGHTS,
            most: float = MOST) -> list[float]:
    """Words to take of each source, given in the order in which the weights repeat."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    full: set[int] = set()
    while True:
        rest = [i for i in range(len(sizes)) if i not in full]
        left = share * sum(sizes) - most * sum(sizes[i] for i in full)
        level = max(left, 0) / sum(weight[i] for i in rest) if rest else 0
        above = {i for i in rest if weight[i] * level > most * sizes[i]}
        if not above:
            return [float(most * sizes[i]) if i in full else weight[i] * level
                    for i in range(len(sizes))]
        full |= above


def recipe(sized: DataFrame, share: float, weights: tuple, most: float,
           block_words: int) -> list[dict]:
    """One entry per source: size, target, blocks and slots."""
    totals = (sized.groupBy("source").agg(F.sum("size").alias("size"))
              .limit(MAX_SOURCES + 1).collect())
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    totals.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    out, slots = [], 0
    for i, (row, target) in enumerate(zip(
            totals, targets([r["size"] for r in totals], share, weights, most), strict=True)):
        size = row["size"]
        blocks = max(1, round(size / block_words))
        words = int(target + 0.5)
        passes, rest = divmod(words, size) if size else (0, 0)
        small, long_ones = divmod(size, blocks)
        cut = block_of(rest - 1, small, long_ones) + 1 if rest else 0
        out.append({"source": row["source"], "s": i, "source_size": size, "target": target,
                    "blocks": blocks, "rest": rest, "slots": passes * blocks + cut,
                    "low": slots})
        slots += out[-1]["slots"]
    return out


def block_of(word: int, small: int, long_ones: int) -> int:
    """Block of a word: the first ``long_ones`` blocks hold ``small + 1`` words."""
    edge = long_ones * (small + 1)
    return word // (small + 1) if word < edge else long_ones + (word - edge) // small


def schedule(spark, plan: list[dict]) -> DataFrame:
    """(n, s, rank): slot n of the schedule takes its source's block for ``rank``.

    Three times as many points as slots are drawn: the gaps of golden-ratio points
    are then small enough that every source meets all its slots; later points of
    a source that has met them are passed over.
    """
    wanted = np.array([p["slots"] for p in plan], dtype=np.int64)
    ends, total = np.cumsum(wanted), int(wanted.sum())
    points = 3 * total + 64 if total else 0
    chunks = spark.range(-(-points // CHUNK))

    def drawn(chunk: int):
        n = np.arange(chunk * CHUNK, min((chunk + 1) * CHUNK, points), dtype=np.int64)
        at = np.minimum(np.modf((n + 1) * GOLDEN)[0] * total, total - 0.5)
        return n, np.searchsorted(ends, at, "right")

    def counted():
        def work(batch):
            for chunk in batch.column("id").to_pylist():
                s, times = np.unique(drawn(chunk)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(s), chunk)), pa.array(s.astype(np.int32)),
                     pa.array(times.astype(np.int64))], ["chunk", "s", "times"])
        return work

    def ranked():
        def work(batch):
            for chunk in batch.column("id").to_pylist():
                n, s = drawn(chunk)
                order = np.argsort(s, kind="stable")
                grouped = s[order]
                first = np.flatnonzero(np.r_[True, grouped[1:] != grouped[:-1]])
                run = np.diff(np.r_[first, len(s)])
                rank = np.arange(len(s)) - np.repeat(first, run)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(s), chunk)), pa.array(n[order]),
                     pa.array(grouped.astype(np.int32)), pa.array(rank)],
                    ["chunk", "n", "s", "inside"])
        return work
    before = per_batch(chunks, "chunk long, s int, times long", counted).select(
        "chunk", "s", (F.sum("times").over(Window.partitionBy("s").orderBy("chunk"))
                       - F.col("times")).alias("before"))
    slots = per_batch(chunks, "chunk long, n long, s int, inside long", ranked)
    quota = plan_table(spark, plan).select("s", "slots")
    return (slots.join(before, ["chunk", "s"])
            .select("n", "s", (F.col("before") + F.col("inside")).alias("rank"))
            .join(quota, "s").filter("rank < slots").select("n", "s", "rank"))


def plan_table(spark, plan: list[dict]) -> DataFrame:
    kinds = ("source string, s int, source_size long, target double, blocks long, "
             "rest long, slots long, low long")
    return spark.createDataFrame([tuple(p.values()) for p in plan], kinds)


WHO = ["doc_id", "text_key", "source", "size", "source_size", "target"]
PIECES = ("doc_id long, text_key long, source string, size long, source_size long, "
          "target double, s int, start long, slot long, pass long, words long")


def slot_pieces(docs: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS,
                most: float = MOST, block_words: int = BLOCK_WORDS,
                seed: int = SEED) -> DataFrame:
    """What every document gives to the slots of the schedule.

    One row per document, block and slot: the document (``start`` is its place in its
    source's stream), the slot, which pass through the source the slot belongs to, and
    the words that the slot takes of the document. A document that no slot takes has one
    row with null slots.
    """
    spark = docs.sparkSession
    shuffle = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"),
                                        F.concat(F.lit("null "), F.xxhash64("text"))),
                             F.lit(f":{seed}")))
    sized = fixed(docs.select(
        "doc_id", "source", F.xxhash64("text").alias("text_key"), shuffle.alias("place"),
        F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0))
        .cast("long").alias("size")))
    plan = recipe(sized, share, weights, most, block_words)
    if not plan:
        return spark.createDataFrame([], PIECES)
    parts = plan_table(spark, plan)
    part = F.substring("place", 1, 3)
    ranges = (sized.groupBy("source", part.alias("range")).agg(F.sum("size").alias("words"))
              .withColumn("base", F.sum("words").over(
                  Window.partitionBy("source").orderBy("range")) - F.col("words"))
              .join(parts.withColumnRenamed("source", "named"),
                    F.col("source").eqNullSafe(F.col("named")))
              .select("source", "range", "base", "s", "source_size", "target", "blocks", "rest")
              .withColumnsRenamed({"source": "of", "range": "in"}))
    inside = Window.partitionBy("source", "range").orderBy(
        "place", F.coalesce("doc_id", F.lit(LAST_ID)), "text_key", "size")
    laid = (sized.withColumn("range", part)
            .withColumn("upto", F.sum("size").over(
                inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .join(ranges, F.col("source").eqNullSafe(F.col("of"))
                  & (F.col("range") == F.col("in")))
            .withColumn("end", F.col("base") + F.col("upto"))
            .withColumn("start", F.expr("end - size"))
            .withColumn("small", F.expr("source_size div blocks"))
            .withColumn("longer", F.expr("source_size % blocks")))
    # a block's slots; the slot that meets the target ends at ``rest``
    slots = schedule(spark, plan).join(parts.select("s", "blocks", "slots", "rest"), "s").select(
        "s", F.expr("rank % blocks").alias("block"), F.expr("rank div blocks").alias("pass"),
        F.col("n").alias("slot"),
        F.expr("if(rest > 0 and rank = slots - 1, rest, null)").alias("stop"))

    def block(word: str) -> str:
        return (f"if({word} < longer * (small + 1), {word} div (small + 1), "
                f"longer + ({word} - longer * (small + 1)) div small)")
    pieces = (laid.filter("size > 0")
              .withColumn("block", F.explode(F.expr(
                  f"sequence({block('start')}, {block('(end - 1)')})")))
              .withColumn("lo", F.expr("greatest(start, block * small + least(block, longer))"))
              .withColumn("hi", F.expr(
                  "least(end, (block + 1) * small + least(block + 1, longer))")))
    given = pieces.join(slots, ["s", "block"], "left").select(
        *WHO, "s", "start", "slot", "pass",
        F.expr("if(slot is null, 0, greatest(least(hi, coalesce(stop, hi)) - lo, 0))")
        .alias("words"))
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    return given.unionByName(laid.filter("size = 0").select(
        *WHO, "s", "start", none.alias("slot"), none.alias("pass"), zero.alias("words")))


def mix(docs: DataFrame, most: float = MOST, **options) -> DataFrame:
    """Per document: doc_id, text_key, source, size, source_size, target, taken, slots.

    ``taken`` sums the document's pieces in all slots; ``slots`` holds the first slot
    that takes some of it in every pass through its source, null where none does.
    """
    passes = [F.min(F.when((F.col("pass") == p) & (F.col("words") > 0), F.col("slot")))
              for p in range(math.ceil(most) + 1)]
    found = slot_pieces(docs, most=most, **options)
    taken = (found.filter("size > 0").groupBy(*WHO, "s", "start")
             .agg(F.sum("words").alias("taken"), F.array(*passes).alias("slots"))
             .drop("s", "start"))
    # blank texts take no room in the stream, so equal ones are not told apart there
    return taken.unionByName(found.filter("size = 0").select(
        *WHO, F.col("words").alias("taken"),
        F.array(*[F.col("slot") for _ in passes]).alias("slots")))


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    return mix(docs, **options).select("doc_id", "size", "source_size",
                                       F.round("target", 6).alias("target"), "taken")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with all columns: a document stands once for every time it is taken,
    in the schedule's order inside a partition.

    The last, partial time holds the first words of the document. ``n_chars``, where
    the input has it, follows the text. Rows equal in id, source and text share their
    words evenly.
    """
    key = ["doc_id", "source", "text_key"]
    found = mix(docs, **options).groupBy(*key).agg(
        F.max("size").alias("size"), F.min("slots").alias("slots"),
        F.expr("sum(taken) div count(*)").alias("taken")).filter("taken > 0")
    rows = with_row(docs, F.col("doc_id").alias("d"), F.col("source").alias("o"),
                    F.xxhash64("text").alias("t"))
    same = (F.col("d").eqNullSafe(F.col("doc_id")) & F.col("o").eqNullSafe(F.col("source"))
            & (F.col("t") == F.col("text_key")))
    out = (rows.join(found, same)
           .select("*", F.posexplode(F.expr(
               "concat(array_repeat(size, cast(taken div size as int)), "
               "if(taken % size > 0, array(taken % size), array()))")).alias("time", "words"))
           .withColumn("slot", F.expr("coalesce(get(slots, time), array_max(slots))"))
           .withColumn("stretch", F.expr(f"slot div {STRETCH}"))
           .repartition("stretch").sortWithinPartitions("stretch", "slot", "doc_id", "text_key"))
    head = F.expr("if(words = size, row.text, array_join(slice(regexp_extract_all("
                  f"row.text, '({WORD_PATTERN})', 1), 1, cast(words as int)), ' '))"
                  .replace("\\", "\\\\"))
    columns = []
    for c in docs.columns:
        value = F.col("row").getField(c)
        if c == "text":
            value = head
        elif c == "n_chars":
            value = F.when(F.col("words") == F.col("size"), value).otherwise(
                F.char_length(head).cast(docs.schema[c].dataType))
        columns.append(value.alias(c))
    return out.select(*columns)
