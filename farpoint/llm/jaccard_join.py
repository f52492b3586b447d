"""Exact Jaccard join of shingle sets in metric space: pivots, regions, windows.

A document's set holds its distinct word shingles; equal sets are one node. Jaccard
distance is a metric, and nodes link at distance ``r`` = 1 - ``percent`` / 100 or less.

First regions. The empty set is the first pivot: set sizes are the distances to it, rings
around it are so wide that linked sets lie in the same ring or in neighbouring ones, and
every set is replicated to the ring below its own as well. In ring j linked sets differ
by at most ``H`` shingles. Shingles are dealt to H + 1 equal parts by their hash, so
linked sets agree on one whole part at least. The sets of a ring that agree on a part
make up a region; every link lies inside some region, and a lone set leaves at once.

Joining regions. All distances to pivots are exact.

1. A node meets the first of its regions' pivots (the smallest node of a region) and is
   linked to it within r. Regions that are one component by then are done: their other
   links would change no component.
2. Every other region takes two pivots, ``a`` and ``b`` (its smallest and greatest node),
   and all its nodes are compared with both. Their Voronoi cells become regions of
   their own. By the triangle inequality, a set linked to one whose nearest pivot is a is
   at most 2r nearer to b than to a: sets in that window are replicated to both cells.
   Sets beyond ``REACH`` of both pivots are a third cell, with a window of r. A region
   that its pivots hardly split (sets that are all about equally far from each other) is
   dealt to blocks, and every two blocks make up a region.
3. Cells are joined recursively in the same way until they are one component, or hold at
   most ``LEAF`` sets and ``LEAF_GRAMS`` shingles. Such a region is joined in one task: sets
   outside its largest component are compared with all, and joining links returned. Such
   regions that share nodes are joined as one while that is small enough, too.

A region of any size sends one row for each node and pivot, and one for each node and
block if it can't be split otherwise: no pair is listed. Texts are read again for the sets
of nodes that share a region; other sets never leave their task.

Shingles are compared by 64-bit hashes, nodes by 64-bit hashes of whole sets with a
second hash as check: if two sets ever share the first, all is hashed anew with another
seed. Null and blank texts have no shingles, are linked with nothing and stand alone.
Null ids sort after all others; a component of null ids has a null id. Rows that repeat
a doc_id are linked by their own texts. Columns besides doc_id and text are not read.
Empty tables give no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_path, materialise_at
from .common import LAST_ID, LOWER, UPPER, fixed, kept_in_worker, per_batch
from .components import components

SHINGLE, PERCENT = 3, 90
LEAF, REACH, GROWTH = 2048, 0.5, 1.25
LEAF_GRAMS, COLUMNS = 1 << 22, 2048
CACHE_WORDS = 300_000
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_K = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _K[1]
    x = (x ^ (x >> np.uint64(27))) * _K[2]
    return x ^ (x >> np.uint64(31))


class Hasher(dict):
    """Shingle sets of texts; a word's hash is kept in a bounded cache."""

    def __init__(self, shingle: int, seed: int):
        import xxhash
        self.digest, self.shingle, self.seed = xxhash.xxh64_intdigest, shingle, seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = found = self.digest(word, self.seed)
        return found

    def __call__(self, text: bytes) -> np.ndarray:
        """Sorted distinct shingle hashes; with fewer words, that of the whole sequence."""
        words = text.translate(_LOWER).split()
        if not words:
            return np.empty(0, np.uint64)
        hashes = np.fromiter((self[w] for w in words), np.uint64, len(words))
        width = min(self.shingle, len(words))
        grams = np.full(len(words) - width + 1, width, dtype=np.uint64)
        for i in range(width):
            grams = mixed(grams * _K[0] + hashes[i:len(words) - width + 1 + i])
        return np.unique(grams)


class Rings:
    """Rings of set sizes around the empty set."""

    def __init__(self, percent: int):
        self.percent, self.low = percent, [1]

    def ring(self, size: int) -> int:
        while self.low[-1] <= size:
            self.low.append(self.low[-1] * 100 // self.percent + 1)
        return bisect_right(self.low, size) - 1

    def parts(self, ring: int) -> int:
        """One more than the shingles in which linked sets may differ, if one is in the ring."""
        self.ring(self.low[-1] if ring + 1 >= len(self.low) else 1)
        union = (self.low[ring + 1] - 1) * 100 // self.percent
        return union * (100 - self.percent) // 100 + 1

    def signatures(self, grams: np.ndarray) -> np.ndarray:
        """A hash of every part of a set, in its own ring and in the one below."""
        own, out = self.ring(len(grams)), []
        for ring in range(max(own - 1, 0), own + 1):
            parts = self.parts(ring)
            part = ((grams >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            content = np.zeros(parts, np.uint64)
            content[part[first].astype(np.int64)] = np.add.reduceat(mixed(grams + _K[2]), first)
            place = np.arange(parts, dtype=np.uint64) * _K[1] + np.full(
                parts, ring + 1, np.uint64) * _K[0]
            out.append(mixed(content + mixed(place)))
        return np.concatenate(out)


MARKED = "doc_id long, text_key long, n long, node long, check long, regions array<long>"


def marked_sets(docs: DataFrame, shingle: int, percent: int, seed: int) -> DataFrame:
    """Every document's set size, node and first regions."""
    def make():
        import xxhash
        grams_of = kept_in_worker(("shingles", shingle, seed), lambda: Hasher(shingle, seed))
        rings = Rings(percent)

        def work(batch):
            size, node, check, regions = [], [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                grams = grams_of(text or b"")
                raw = grams.tobytes()
                size.append(len(grams))
                node.append(xxhash.xxh3_64_intdigest(raw, seed))
                check.append(xxhash.xxh64_intdigest(raw, seed))
                regions.append(rings.signatures(grams) if len(grams) else grams)
            upto = np.cumsum([0, *map(len, regions)]).astype(np.int32)
            long = lambda v: pa.array(np.array(v, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pc.cast(batch.column("doc_id"), pa.int64()), batch.column("text_key"),
                 pa.array(size, pa.int64()), long(node), long(check),
                 pa.ListArray.from_arrays(pa.array(upto), long(np.concatenate(regions)))],
                ["doc_id", "text_key", "n", "node", "check", "regions"])
        return work
    return per_batch(docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")),
                     MARKED, make)


def sets_of(docs: DataFrame, marked: DataFrame, wanted: DataFrame, shingle: int,
            seed: int) -> DataFrame:
    """(node, grams): the sets of the wanted nodes, from one text of each."""
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), "text_key"))
    chosen = (marked.join(wanted, "node", "leftsemi").groupBy("node").agg(first.alias("first"))
              .select("node", "first.*"))
    texts = (docs.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"),
                         F.xxhash64("text").alias("text_key"), "text")
             .join(chosen, ["id", "text_key"]).groupBy("node").agg(F.first("text").alias("text")))

    def make():
        grams_of = kept_in_worker(("shingles", shingle, seed), lambda: Hasher(shingle, seed))

        def work(batch):
            found = [grams_of(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            upto = np.cumsum([0, *map(len, found)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.ListArray.from_arrays(
                    pa.array(upto), pa.array(np.concatenate(found).view(np.int64)))],
                ["node", "grams"])
        return work
    return per_batch(texts, "node long, grams array<long>", make)


def measured(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Distance of every (node, pivot), and whether they link."""
    both = (pairs.join(sets, "node")
            .join(sets.select(F.col("node").alias("pivot"), F.col("grams").alias("other")), "pivot")
            .select("node", "pivot", (F.size("grams") + F.size("other")).alias("n"),
                    F.size(F.array_intersect("grams", "other")).alias("common")))
    union = F.col("n") - F.col("common")
    return both.select("node", "pivot", (1 - F.col("common") / union).alias("far"),
                       (100 * F.col("common") >= percent * union).alias("linked"))


def unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(region, node, label) of regions that are not yet one component.

    A node that is in no link yet is a component of its own.
    """
    known = members.join(labels.withColumnRenamed("component", "label"), "node", "left").select(
        "region", "node", F.coalesce("label", "node").alias("label"))
    open_ = (known.groupBy("region").agg(F.min("label").alias("low"), F.max("label").alias("high"))
             .filter("low != high").select("region"))
    return known.join(open_, "region", "leftsemi")


def distinct_regions(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """(region, size, grams, a, b): one of each kind of regions that hold the same nodes."""
    held = members.join(sizes, "node").groupBy("region").agg(
        F.count("*").alias("size"), F.sum("n").alias("grams"), F.min("node").alias("a"),
        F.max("node").alias("b"), F.bit_xor(F.xxhash64("node")).alias("content"))
    return held.groupBy("size", "grams", "a", "b", "content").agg(
        F.min("region").alias("region")).drop("content")


def leaf_rows(rest: DataFrame, small: DataFrame, sizes: DataFrame, leaf: int,
              leaf_grams: int) -> DataFrame:
    """(region, node, label) of the regions to join as leaves, overlapping ones united.

    A node lies in many regions, and those of one cluster of copies hold about the same
    nodes. Regions that share nodes become one, so each set is sent once, as long as what
    they make up is still small enough for a leaf; else they stay as they are.
    """
    rows = rest.join(small, "region")
    # a node hangs on its smallest pivot only, and so do its other pivots: one link a node
    low = fixed(rows.groupBy("node").agg(F.min("a").alias("b")))
    chains = components(
        low.select(F.col("node").alias("a"), "b")
        .union(rows.select("node", "a").distinct().join(low, "node").select("a", "b"))
        .filter("a != b").distinct()).withColumnRenamed("component", "chain")
    held = fixed(rows.select("node", "label").distinct().join(chains, "node").join(sizes, "node")
                 .select("chain", "node", "label", "n"))
    fits = (held.groupBy("chain").agg(F.count("*").alias("size"), F.sum("n").alias("grams"))
            .filter((F.col("size") <= leaf) & (F.col("grams") <= leaf_grams)).select("chain"))
    one = held.join(fits, "chain").select(F.col("chain").alias("region"), "node", "label")
    apart = held.join(fits, "chain", "leftanti").select("node")
    return one.union(rows.join(apart, "node", "leftsemi").select("region", "node", "label"))


def common_shingles(some: np.ndarray, grams: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of ``some`` of the sets with all of them, by products of
    0/1 matrices over the shingles that two sets or more hold."""
    owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    _, column, times = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    kept = np.flatnonzero(times[column] > 1)
    number = np.cumsum(times > 1) - 1
    owner, column = owner[kept], number[column[kept]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(some), len(grams)), dtype=np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        low, high = np.searchsorted(column, (start, start + COLUMNS))
        holds = np.zeros((len(grams), COLUMNS), dtype=np.float32)
        holds[owner[low:high], column[low:high] - start] = 1
        out += holds[some] @ holds.T
    return out.astype(np.int64)


def joining_links(nodes: np.ndarray, labels: np.ndarray, grams: list[np.ndarray],
                  percent: int) -> list[tuple[int, int]]:
    """Links between components, as few as join all that any link joins."""
    _, label, times = np.unique(labels, return_inverse=True, return_counts=True)
    some = np.flatnonzero(label != times.argmax())
    size = np.array([len(g) for g in grams])
    common = common_shingles(some, grams)
    union = size[some][:, None] + size[None, :] - common
    x, y = np.nonzero((100 * common >= percent * union) & (label[some][:, None] != label[None, :]))
    x = some[x]
    low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
    _, first = np.unique(low * len(times) + high, return_index=True)
    top, out = list(range(len(times))), []

    def find(i):
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i
    for i in first.tolist():
        a, b = find(int(label[x[i]])), find(int(label[y[i]]))
        if a != b:
            top[a] = b
            out.append((int(nodes[x[i]]), int(nodes[y[i]])))
    return out


def leaf_links(leaves: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that join components inside small regions, by comparing their sets."""
    def join(rows: pa.Table) -> pa.Table:
        found = joining_links(rows.column("node").to_numpy(), rows.column("label").to_numpy(),
                              [g.values.to_numpy() for g in rows.column("grams")], percent)
        return pa.table({"node": pa.array([a for a, _ in found], pa.int64()),
                         "pivot": pa.array([b for _, b in found], pa.int64())})
    return (leaves.join(sets, "node").groupBy("region")
            .applyInArrow(join, "node long, pivot long"))


def cells(members: DataFrame, pivots: DataFrame, far: DataFrame, percent: int,
          level: int) -> DataFrame:
    """The next level's (region, node): Voronoi cells with windows, without the pivots."""
    r, slack = 1 - percent / 100, 1e-9
    rest = (members.join(pivots, "region").filter("node != a and node != b")
            .join(far.select("node", F.col("pivot").alias("a"), F.col("far").alias("to_a")),
                  ["node", "a"])
            .join(far.select("node", F.col("pivot").alias("b"), F.col("far").alias("to_b")),
                  ["node", "b"]))
    gap = F.col("to_a") - F.col("to_b")
    choice = F.filter(F.array(
        F.when((gap <= 2 * r + slack) & (F.col("to_a") <= REACH + slack), 0),
        F.when((-gap <= 2 * r + slack) & (F.col("to_b") <= REACH + slack), 1),
        F.when(F.least("to_a", "to_b") > REACH - r - slack, 2)), lambda c: c.isNotNull())
    dealt, at = materialise_at(rest.select("region", "node", "blocks", choice.alias("cells")),
                               "cells")
    split = dealt.groupBy("region").agg(
        (F.sum(F.size("cells")) <= GROWTH * F.count("*")).alias("splits"))
    # a node of block x goes to the region of every pair of blocks that x is part of
    block = F.pmod(F.xxhash64("node", F.lit(level)), F.col("blocks"))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda other: (
        F.least(block, other) * F.col("blocks") + F.greatest(block, other) + 3))
    return dealt.join(split, "region").select(
        F.explode(F.when(F.col("splits"), F.col("cells").cast("array<long>")).otherwise(pairs))
        .alias("c"), "region", "node").select(
        F.xxhash64("region", F.lit(level), "c").alias("region"), "node"), at


def jaccard_links(docs: DataFrame, marked: DataFrame, shingle: int, percent: int, seed: int,
                  leaf: int = LEAF, leaf_grams: int = LEAF_GRAMS) -> DataFrame:
    """(node, component) of every node that is linked to another one."""
    spark, scratch = docs.sparkSession, []

    def kept(frame: DataFrame, name: str) -> DataFrame:
        frame, path = materialise_at(frame, name)
        scratch.append(path)
        return frame

    dealt = marked.filter("n > 0").select(F.explode("regions").alias("region"), "node")
    shared = (dealt.groupBy("region").agg(F.min("node").alias("pivot"), F.max("node").alias("last"))
              .filter("pivot != last").select("region", "pivot"))
    members = kept(dealt.join(shared, "region").distinct(), "regions")
    sets = kept(sets_of(docs, marked, members.select("node").distinct(), shingle, seed), "sets")
    sizes = sets.select("node", F.size("grams").alias("n"))
    first = members.groupBy("node").agg(F.min("pivot").alias("pivot")).filter("pivot != node")
    links = [kept(measured(first, sets, percent).filter("linked").select("node", "pivot"),
                  "links")]

    def labels():
        return components(reduce(DataFrame.union, links).select(
            F.col("node").alias("a"), F.col("pivot").alias("b")))
    found = labels()
    members = members.select("region", "node")
    for level in count():
        rest = kept(unsettled(members, found), "open-regions")
        if rest.isEmpty():
            break
        regions = kept(distinct_regions(rest, sizes), "pivots")
        fits = (F.col("size") <= leaf) & (F.col("grams") <= leaf_grams)
        small = regions.filter(fits).select("region", "a")
        # two blocks fill half a leaf
        large = regions.filter(~fits).select("region", "a", "b", F.ceil(F.greatest(
            F.col("size") / (leaf / 4), F.col("grams") / (leaf_grams / 4))).alias("blocks"))
        leaves = leaf_rows(rest, small, sizes, leaf, leaf_grams)
        links.append(kept(leaf_links(leaves, sets, percent), "links"))
        if large.isEmpty():
            found = labels()
            break
        inside = rest.join(large, "region")
        pairs = (inside.select("node", F.explode(F.array("a", "b")).alias("pivot"))
                 .filter("node != pivot").distinct())
        far = kept(measured(pairs, sets, percent), "pivot-distances")
        links.append(far.filter("linked").select("node", "pivot"))
        found = labels()
        members, at = cells(rest.select("region", "node"), large, far, percent, level)
        scratch.append(at)
    for path in scratch:
        drop_path(spark, path)
    return found


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
                       leaf: int = LEAF) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least doc_id reachable)."""
    spark = docs.sparkSession
    for seed in count():
        marked, path = materialise_at(marked_sets(docs, shingle, percent, seed), "marked-sets")
        clash = marked.groupBy("node").agg(F.min("check").alias("low"), F.max("check").alias("high"))
        if clash.filter("low != high").isEmpty():
            break
        drop_path(spark, path)
    joined = jaccard_links(docs, marked, shingle, percent, seed, leaf)
    order = F.coalesce("doc_id", F.lit(LAST_ID))
    nodes = (marked.filter("n > 0").groupBy("node").agg(F.min(order).alias("least"))
             .join(joined, "node", "left").select(
                 "node", "least", F.coalesce("component", "node").alias("component")))
    least = nodes.groupBy("component").agg(F.min("least").alias("least_id"))
    named = nodes.drop("least").join(least, "component").select("node", "least_id")
    linked = marked.filter("n > 0").select("doc_id", "n", "node").join(named, "node").select(
        "doc_id", "n", "least_id")
    alone = marked.filter("n = 0").select("doc_id", "n", order.alias("least_id"))
    return linked.union(alone).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("least_id") != LAST_ID, F.col("least_id")).alias("component_id"))
