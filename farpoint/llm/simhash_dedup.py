"""SimHash near-dedup with BK-trees over sharded fingerprints.

Fingerprints that differ in at most ``radius`` bits agree on at least
``choose`` of ``radius + choose`` bit blocks. So every distinct fingerprint goes
to one shard for each way to pick ``choose`` blocks, keyed by their bits, and
every link lies inside some shard. A shard's fingerprints form a BK-tree: a
child hangs on its parent by their integer Hamming distance. Each fingerprint is
searched in the trees of its own shards only, following no edge but those within
the radius of its distance to the parent, so no tree leaves the tasks that need
it. Many trees are built and searched side by side, level by level, over arrays;
pairs in flight are bounded, whatever a shard's size.

``choose`` only sets how fine the shards are: enough bits for about
``SHARD_ROWS`` distinct fingerprints in each. The links found are the same.

Null and blank texts have fingerprint zero and link like any other. Equal
fingerprints are one node, so copies cost nothing beyond their row. Texts are
read whole. Null ids sort after all others and a component of null ids only has
a null id. Rows that repeat a doc_id are linked by their own texts. Empty tables
give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LAST_ID, LOWER_ASCII, WORD, fixed, per_batch, texts_of, with_row
from .components import components

SHINGLE, RADIUS, SEED = 4, 4, 42
SHARD_ROWS = 8
PAIRS = 1 << 18


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash: a bit is set where over half of the shingle hashes set it."""
    import xxhash

    words = WORD.findall(text.translate(LOWER_ASCII) if not text.isascii() else text.lower())
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    blank = " "
    grams = map(blank.join, zip(*[words[i:] for i in range(shingle)], strict=False)) \
        if len(words) >= shingle else [blank.join(words)]
    hashes = np.array([digest(g, SEED) for g in grams], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for part in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[part:part + 4096].view(np.uint8).reshape(-1, 8),
                             axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, bits): bits is the fingerprint as a signed long."""
    def make():
        def work(batch):
            bits = [fingerprint(t, shingle) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [pc.cast(batch.column("doc_id"), pa.int64()), batch.column("text_key"),
                 pa.array(np.array(bits, dtype="<u8").view("<i8"))],
                ["doc_id", "text_key", "bits"])
        return work
    return per_batch(docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")),
                     "doc_id long, text_key long, bits long", make)


def block_masks(radius: int, choose: int) -> list[int]:
    """One mask for each choice of ``choose`` of the ``radius + choose`` blocks."""
    n = radius + choose
    edges = [round(i * 64 / n) for i in range(n + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(blocks, choose)]


def shard_choice(n: int, radius: int) -> int:
    """Blocks to agree on, so that shards hold about ``SHARD_ROWS`` of ``n`` keys."""
    choose = 1
    while choose < 4 and n >> (64 * choose // (radius + choose)) > SHARD_ROWS:
        choose += 1
    return choose


class BkForest:
    """BK-trees of many shards, grown level by level; node 0.. are the rows themselves."""

    def __init__(self, shard: np.ndarray, bits: np.ndarray):
        """``shard`` is sorted; the first row of each shard is its tree's root."""
        self.bits = bits
        n = len(bits)
        first = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
        self.root = first[np.cumsum(np.r_[True, shard[1:] != shard[:-1]]) - 1]
        parent = self.root.copy()
        waiting = np.setdiff1d(np.arange(n), first, assume_unique=True)
        edges = []
        while len(waiting):
            far = np.bitwise_count(bits[waiting] ^ bits[parent[waiting]]).astype(np.int64)
            slot = parent[waiting] * 65 + far
            _, chosen, group = np.unique(slot, return_index=True, return_inverse=True)
            child = waiting[chosen]
            edges.append((slot[chosen], child))
            rest = np.ones(len(waiting), dtype=bool)
            rest[chosen] = False
            parent[waiting] = child[group]
            waiting = waiting[rest]
        slots = np.concatenate([e[0] for e in edges]) if edges else np.empty(0, np.int64)
        children = np.concatenate([e[1] for e in edges]) if edges else np.empty(0, np.int64)
        order = np.argsort(slots)
        self.slots, self.children = slots[order], children[order]

    def search(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Arrays of linked (row, other row) pairs, row < other."""
        stack = [(np.arange(a, min(a + PAIRS, len(self.root))),) for a in
                 range(0, len(self.root), PAIRS)]
        stack = [(q, self.root[q]) for (q,) in stack]
        while stack:
            query, node = stack.pop()
            far = np.bitwise_count(self.bits[query] ^ self.bits[node]).astype(np.int64)
            hit = (far <= radius) & (query < node)
            if hit.any():
                yield query[hit], node[hit]
            low = np.searchsorted(self.slots, node * 65 + np.maximum(far - radius, 0))
            high = np.searchsorted(self.slots, node * 65 + np.minimum(far + radius, 64), "right")
            count = high - low
            upto = np.cumsum(count)
            start = 0
            while start < len(count):
                base = upto[start - 1] if start else 0
                stop = max(int(np.searchsorted(upto, base + PAIRS, "right")), start + 1)
                some = count[start:stop]
                total = int(some.sum())
                if total:
                    at = np.repeat(low[start:stop] - (np.cumsum(some) - some), some) + \
                        np.arange(total)
                    stack.append((np.repeat(query[start:stop], some), self.children[at]))
                start = stop


class Links:
    """Union-find over rows: keeps only the pairs that join two groups."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, rows: np.ndarray) -> np.ndarray:
        found = self.parent[rows]
        while True:
            up = self.parent[found]
            if np.array_equal(up, found):
                self.parent[rows] = found
                return found
            found = up

    def joining(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
        apart = self.find(a) != self.find(b)
        for x, y in zip(a[apart].tolist(), b[apart].tolist(), strict=True):
            rx, ry = int(self.find(np.array([x]))[0]), int(self.find(np.array([y]))[0])
            if rx != ry:
                self.parent[max(rx, ry)] = min(rx, ry)
                yield x, y


def shard_links(shard: np.ndarray, bits: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Pairs of rows, enough to join all rows that any chain of links joins."""
    links = Links(len(bits))
    for a, b in BkForest(shard, bits).search(radius):
        yield from links.joining(a, b)


def near_links(nodes: DataFrame, radius: int = RADIUS, choose: int | None = None) -> DataFrame:
    """(a, b) fingerprints linked within the radius, enough to join every component."""
    nodes = fixed(nodes.select("bits").distinct())
    choose = choose or shard_choice(nodes.count(), radius)
    masks = [m - (1 << 64) if m >> 63 else m for m in block_masks(radius, choose)]
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("bits").bitwiseAND(F.lit(m)))
                     for i, m in enumerate(masks)])
    sharded = (nodes.select(F.explode(keys).alias("shard"), "bits")
               .repartition("shard").sortWithinPartitions("shard", "bits"))

    def run(batches):
        held = []
        for batch in batches:
            held.append(batch)
            shard = batch.column("shard").to_numpy()
            if not len(shard) or held[0].column("shard")[0].as_py() == shard[-1]:
                continue
            whole = pa.Table.from_batches(held)
            keys = whole.column("shard").to_numpy()
            done = int(np.searchsorted(keys, keys[-1]))
            held = whole.slice(done).combine_chunks().to_batches()
            yield from found(whole.slice(0, done))
        if held:
            yield from found(pa.Table.from_batches(held))

    def found(rows):
        bits = rows.column("bits").to_numpy()
        # lone fingerprints of a shard have nothing to link to
        shard = rows.column("shard").to_numpy()
        same = shard[1:] == shard[:-1]
        alone = ~(np.r_[False, same] | np.r_[same, False])
        shard, bits = shard[~alone], bits[~alone]
        if not len(bits):
            return
        pairs = np.array(list(shard_links(shard, bits.view("<u8"), radius)), dtype=np.int64)
        if len(pairs):
            yield pa.RecordBatch.from_arrays(
                [pa.array(bits[pairs[:, 0]]), pa.array(bits[pairs[:, 1]])], ["a", "b"])
    return sharded.mapInArrow(run, "a long, b long")


def simhash_components(docs: DataFrame, shingle: int = SHINGLE,
                       radius: int = RADIUS) -> DataFrame:
    """doc_id, text_key, bits, component and component_id of every document.

    component is the component itself (its smallest fingerprint); component_id is its
    smallest doc_id, which is null, or another's too, where ids are null or repeat.
    """
    marked = fixed(fingerprints(docs, shingle))
    order = F.coalesce("doc_id", F.lit(LAST_ID))
    nodes = fixed(marked.groupBy("bits").agg(F.min(order).alias("least_id")))
    joined = components(near_links(nodes, radius))
    nodes = nodes.join(joined.withColumnRenamed("node", "bits"), "bits", "left").select(
        "bits", F.coalesce("component", "bits").alias("component"), "least_id")
    least = nodes.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = fixed(nodes.join(least, "component").select("bits", "component", "component_id"))
    return marked.join(named, "bits").select(
        "doc_id", "text_key", "bits", "component",
        F.when(F.col("component_id") != LAST_ID, F.col("component_id")).alias("component_id"))


def simhash_report(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fingerprint as 16 hex digits, component_id."""
    return simhash_components(docs, shingle, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of each component's smallest doc_id, with all their columns.

    Of rows that share that id, those of the text with the smallest hash stay; of
    null ids, likewise, where a component has no other. Repeated rows stay together.
    """
    found = simhash_components(docs, shingle, radius)
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), "text_key"))
    kept = (found.groupBy("component")
            .agg(first.alias("first")).select("first.id", "first.text_key"))
    rows = with_row(docs, F.coalesce(F.col("doc_id"), F.lit(LAST_ID)).alias("id"),
                    F.xxhash64("text").alias("text_key"))
    return rows.join(kept, ["id", "text_key"], "leftsemi").select("row.*")
