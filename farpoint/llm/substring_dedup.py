"""Suffix-array dedup: bytes of long strings that an earlier document holds already.

A byte goes if a string of ``length`` bytes that covers it also starts in a
document with a smaller doc_id; strings are judged on the input.

1. Anchors. Of the grams of ``GRAM`` bytes inside every string, the one with the
   smallest hash (leftmost of equals) is the string's anchor, so equal strings have
   equal anchors at equal places. Runs of strings with one anchor are one context.
2. Every batch of documents sends its anchor hashes, packed by hash range and at most
   two of a kind; ranges tell which hashes occur in two documents. A Bloom filter
   of those (at most ``BLOOM_BITS`` bits, whatever the corpus) goes to all tasks. It
   only spares work: an anchor that passes by mistake meets no partner.
3. Contexts of passing anchors combine by content to their smallest doc_id before
   they are dealt by anchor. A bucket of one content is decided by that id. Otherwise
   a suffix array of the bucket's contexts groups equal strings, each with its
   smallest doc_id. Buckets of over ``BUCKET`` contexts are dealt further: contexts
   are halved by where their strings hold the anchor, and each half goes by the longer
   passage its strings share, until buckets are small or a half is one string. Only
   such strings that stand in over ``BUCKET`` contexts are decided by an aggregate.
4. Strings whose smallest id is below their document's own become removed runs.

The suffix array is built by linear grouping: suffixes are grouped by Lyndon
prefix, the groups being processed in descending order along previous-smaller
pointers; then each group's order is emitted in one ascending sweep.

Null texts are empty; texts shorter than ``length`` stay whole. A null doc_id is
larger than any other. Rows with one doc_id never remove each other's bytes; each is
cut by its own text. Texts are read whole. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_path, materialise, materialise_at
from .common import LAST_ID, fixed, per_batch, release

LENGTH, GRAM = 50, 20
BUCKET = 2048
BLOCK = 1 << 16
BLOOM_BITS = 1 << 28
HOT_ANCHORS = 100_000
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(29))


def suffix_array(text: list[int]) -> list[int]:
    """Start positions of the suffixes of ``text`` in ascending order."""
    n = len(text)
    members: dict[int, set[int]] = {}
    for i, c in enumerate(text):
        members.setdefault(c, set()).add(i)
    group = [0] * n
    groups = [members[c] for c in sorted(members)]
    for g, block in enumerate(groups):
        for i in block:
            group[i] = g
    # neighbours of each group; new groups come above an old one, so 0 stays the lowest
    lower = list(range(-1, len(groups) - 1))
    higher = [*range(1, len(groups)), -1]

    def split(moved: set[int], old: int) -> None:
        new, above = len(groups), higher[old]
        groups.append(moved)
        for j in moved:
            group[j] = new
        lower.append(old)
        higher.append(above)
        higher[old] = new
        if above >= 0:
            lower[above] = new
    previous = [-1] * n
    done = bytearray(n)
    g = len(groups) - 1
    while g >= 0:
        block = groups[g]
        if len(block) == 1:  # one suffix moves one other at most
            for i in block:
                done[i] = 1
                j = i - 1
                while j >= 0 and done[j]:
                    j = previous[j]
                previous[i] = j
            if j >= 0 and len(groups[group[j]]) > 1:
                groups[group[j]].remove(j)
                split({j}, group[j])
            g = lower[g]
            continue
        times: dict[int, int] = {}
        for i in sorted(block):
            done[i] = 1
            j = i - 1
            while j >= 0 and done[j]:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        parts: dict[tuple[int, int], set[int]] = {}
        for j, k in times.items():
            parts.setdefault((k, group[j]), set()).add(j)
        for k, old in sorted(parts, reverse=True):
            moved = parts[k, old]
            if len(moved) < len(groups[old]):  # else the whole group's place is the same
                groups[old] -= moved
                split(moved, old)
        g = lower[g]
    at, free, place = 0 if n else -1, 1, [0] * len(groups)
    while at >= 0:
        place[at] = free
        free += len(groups[at])
        at = higher[at]
    order = [0] * (n + 1)
    order[0] = n
    placed = bytearray(n)
    for i in range(n + 1):
        s = order[i] - 1
        while s >= 0 and not placed[s]:
            placed[s] = 1
            g = group[s]
            order[place[g]] = s
            place[g] += 1
            s = previous[s]
    return order[1:]


def alike(sides: list[bytes]) -> int:
    """How far all ``sides`` agree, each as far as it goes."""
    longest = max(sides, key=len)
    return min([len(commonprefix([longest, s])) for s in sides if not longest.startswith(s)],
               default=len(longest))


def reach(sides: list[int], size: int) -> list[int]:
    """How many leading bytes of each side, a number of ``size`` bytes, another side has too."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    shared = [0, *[size - ((sides[a] ^ sides[b]).bit_length() + 7) // 8
                   for a, b in zip(order, order[1:], strict=False)], 0]
    out = [0] * len(sides)
    for i, c in enumerate(order):
        out[c] = max(shared[i], shared[i + 1])
    return out


def repeatable(contexts: list[bytes], at: list[int], length: int) -> list[tuple[int, int]]:
    """First and last string of each context that another context may hold too.

    Equal strings hold the anchor at one place, so they agree in all before it and in all
    behind it: what goes beyond what any other context shares on a side is held once.
    """
    size = length - GRAM
    left = reach([int.from_bytes(x[max(0, a - size):a], "little")
                  << 8 * (size - min(a, size)) for x, a in zip(contexts, at, strict=True)], size)
    right = reach([int.from_bytes(x[a + GRAM:a + length].ljust(size, b"\0"), "big")
                   for x, a in zip(contexts, at, strict=True)], size)
    return [(max(0, a - m), min(len(x) - length, a - size + r))
            for x, a, m, r in zip(contexts, at, left, right, strict=True)]


END, JOINT = -1, 256


def least_ids(contexts: list[bytes], ids: list[int], at: list[int] | None = None,
              length: int = LENGTH) -> list[list[int]]:
    """For every string of ``length`` bytes in every context, the smallest id of its equals.

    ``at`` is where each context holds one gram that all of them share and that lies
    inside all their strings. It then counts as one symbol, the joint, together with
    what all contexts have alike on both sides of it, which shortens the text; equal
    strings stay neighbours. Strings that start inside the joint are ordered by it. Only
    what two contexts may both hold goes into the text.
    """
    if at is not None:
        out = [[i] * (len(x) - length + 1) for x, i in zip(contexts, ids, strict=True)]
        some = [(c, first, last) for c, (first, last)
                in enumerate(repeatable(contexts, at, length)) if first <= last]
        found = equal_strings([contexts[c][a:b + length] for c, a, b in some],
                              [ids[c] for c, *_ in some], [at[c] - a for c, a, _ in some], length)
        for (c, a, b), least in zip(some, found, strict=True):
            out[c][a:b + 1] = least
        return out
    return equal_strings(contexts, ids, at, length)


def equal_strings(contexts: list[bytes], ids: list[int], at: list[int] | None,
                  length: int) -> list[list[int]]:
    """``least_ids`` of contexts as they are, by one suffix array."""
    if not contexts:
        return []
    counts = [len(context) - length + 1 for context in contexts]
    out = [[0] * n for n in counts]
    text: list[int] = []
    place: dict[int, tuple[int, int]] = {}
    joints: dict[int, int] = {}
    before = 0
    if at is not None:
        before = alike([x[:a][::-1] for x, a in zip(contexts, at, strict=True)])
        after = GRAM + alike([x[a + GRAM:] for x, a in zip(contexts, at, strict=True)])
    for c, context in enumerate(contexts):
        start = len(text)
        free = len(context) if at is None else max(0, at[c] - before)
        for j in range(min(counts[c], free)):
            place[start + j] = c, j
        text += context[:free]
        if at is not None:
            joints[len(text)] = c
            text.append(JOINT)
            text += context[at[c] + after:]
        text.append(END)

    def group(neighbours):
        last, same = None, []
        for c, j in neighbours:
            string = contexts[c][j:j + length]
            if string != last:
                close(same)
                last, same = string, []
            same.append((c, j))
        close(same)

    def close(same):
        if same:
            least = min([ids[c] for c, _ in same])
            for c, j in same:
                out[c][j] = least
    order = suffix_array(text)
    group([place[s] for s in order if s in place])
    joined = [joints[s] for s in order if s in joints]
    for back in range(before + 1 if joints else 0):
        group([(c, at[c] - back) for c in joined if 0 <= at[c] - back < counts[c]])
    return out


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each gram of ``GRAM`` (16 + 4) bytes."""
    a, b, shift = _MIX

    def joined(left, right):
        h = (left * a) ^ (right + b)
        h ^= h >> shift
        return h * b
    h = raw.astype(np.uint64) + np.uint64(1)
    four = None
    for width in (1, 2, 4, 8):
        h = joined(h[:-width], h[width:])
        four = h if width == 2 else four
    h = joined(h[:-4], four[16:])
    return h ^ (h >> np.uint64(32))


def sliding_min(values: np.ndarray, window: int) -> np.ndarray:
    n, done, out = len(values) - window + 1, 1, values
    while 2 * done <= window:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    return np.minimum(out[:n], out[window - done:window - done + n])


def blocks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts): whole texts of together about ``BLOCK`` bytes."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= BLOCK:
            yield start, texts[start:i + 1]
            start, held = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


@dataclass
class Contexts:
    """The runs of strings with one anchor: text, anchor hash, first and last string,
    all positions in the block."""
    text: np.ndarray
    anchors: np.ndarray
    first: np.ndarray
    last: np.ndarray
    grams: np.ndarray
    starts: np.ndarray

    def offsets(self, some: np.ndarray, length: int) -> np.ndarray:
        """Where each of ``some`` holds its anchor, from its own start."""
        window = np.arange(length - GRAM + 1)
        return (self.grams[self.first[some][:, None] + window]
                == self.anchors[some][:, None]).argmax(axis=1)


def contexts_of(texts: list[bytes], length: int = LENGTH) -> Contexts:
    """The contexts of the texts of one block; none crosses texts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    counts = np.maximum(sizes - length + 1, 0)
    total = int(counts.sum())
    if not total:
        none = np.empty(0, np.int64)
        return Contexts(none, np.empty(0, np.uint64), none, none, none, ends - sizes)
    grams = gram_hashes(np.frombuffer(b"".join(texts), np.uint8))
    before = np.cumsum(counts) - counts
    at = np.arange(total) + np.repeat(ends - sizes - before, counts)
    least = sliding_min(grams, length - GRAM + 1)[at]
    # a run ends where the smallest hash changes or where the anchor itself is left behind
    new = np.r_[True, (least[1:] != least[:-1]) | (grams[at[:-1]] == least[:-1])]
    new[before[counts > 0]] = True
    run = np.flatnonzero(new)
    first, last = at[run], at[np.r_[run[1:], total] - 1]
    return Contexts(np.searchsorted(ends, first, "right"), least[run], first, last, grams,
                    ends - sizes)


def bloom_probes(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    shift = np.uint64(64 - int(math.log2(bits)))
    return [(hashes * np.uint64(m)) >> shift for m in
            (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def shared_anchors(texts: DataFrame, length: int) -> DataFrame:
    """Packed hashes of the anchors that occur in two or more documents."""
    ranges = 64 * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def make():
        def work(batch):
            found = []
            for _, texts in blocks(batch.column("bytes").to_pylist()):
                c = contexts_of(texts, length)
                order = np.lexsort((c.text, c.anchors))
                text, hashes = c.text[order], c.anchors[order]
                again = (text[1:] == text[:-1]) & (hashes[1:] == hashes[:-1])
                found.append(hashes[~np.r_[np.zeros(min(1, len(hashes)), bool), again]])
            hashes = np.sort(np.concatenate(found))
            third = np.r_[False, False, hashes[2:] == hashes[:-2]]
            hashes = hashes[~third[:len(hashes)]]
            at = (hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
            cuts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else []
            ends = [*cuts[1:], len(hashes)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(at[c]) for c in cuts], pa.int32()),
                 pa.array([hashes[a:b].tobytes() for a, b in zip(cuts, ends, strict=False)],
                          pa.binary())], ["range", "hashes"])
        return work

    def meet(batches):
        def rows():
            for batch in batches:
                yield from zip(batch.column("range").to_pylist(), batch.column("hashes"),
                               strict=True)
        for at, same in groupby(rows(), key=lambda r: r[0]):
            hashes = np.sort(np.concatenate(
                [np.frombuffer(h.as_buffer(), np.uint64) for _, h in same]))
            twice = np.unique(hashes[1:][hashes[1:] == hashes[:-1]])
            yield pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int32()), pa.array([twice.tobytes()], pa.binary()),
                 pa.array([len(twice)], pa.int64())], ["range", "hashes", "n"])
    sent = per_batch(texts.select("bytes"), "range int, hashes binary", make)
    return (sent.repartition("range").sortWithinPartitions("range")
            .mapInArrow(meet, "range int, hashes binary, n long"))


def bloom_filter(shared: DataFrame) -> np.ndarray:
    """Bits of the packed hashes; its size follows their number up to ``BLOOM_BITS``."""
    n = shared.agg(F.sum("n")).first()[0] or 0
    bits = min(BLOOM_BITS, 1 << max(16, math.ceil(math.log2(12 * n + 1))))
    page = 1 << 16

    def make():
        def work(batch):
            hashes = np.frombuffer(b"".join(batch.column("hashes").to_pylist()), np.uint64)
            filled = {}
            for probe in bloom_probes(hashes, bits):
                at = np.unique(probe)
                pages = (at >> np.uint64(16)).astype(np.int64)
                cuts = np.flatnonzero(np.r_[True, pages[1:] != pages[:-1]]) if len(at) else []
                for a, b in zip(cuts, [*cuts[1:], len(at)], strict=False):
                    mine = filled.setdefault(int(pages[a]), np.zeros(page, dtype=bool))
                    mine[at[a:b] & np.uint64(page - 1)] = True
            yield pages_of({p: np.packbits(f) for p, f in filled.items()})
        return work

    def pages_of(filled):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(filled), pa.int64()),
             pa.array([f.tobytes() for f in filled.values()], pa.binary())], ["page", "bits"])

    def unite(batches):
        filled = {}
        for batch in batches:
            for p, found in zip(batch.column("page").to_pylist(),
                                batch.column("bits").to_pylist(), strict=True):
                if p not in filled:
                    filled[p] = np.zeros(page // 8, dtype=np.uint8)
                filled[p] |= np.frombuffer(found, np.uint8)
        yield pages_of(filled)
    out = np.zeros((bits >> 16, page // 8), dtype=np.uint8)
    # the pages are united in tasks, so at most ``bits`` bits reach the driver
    for row in (per_batch(shared, "page long, bits binary", make).repartition("page")
                .mapInArrow(unite, "page long, bits binary").collect()):
        out[row["page"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def content_digest(anchor: int, content: bytes) -> bytes:
    import xxhash
    return xxhash.xxh3_128_digest(content, seed=anchor & 0xFFFFFFFF)


CONTENTS = "anchor long, at int, bytes binary, id long"
PLACES = "digest binary, id long, text_key long, first int, n int"


def passing_contexts(texts: DataFrame, bloom, length: int, contents: bool) -> DataFrame:
    """The contexts whose anchor passes: their contents, or the places where they stand."""
    def make():
        filled = bloom.value
        bits = 8 * len(filled)

        def passes(hashes):
            ok = np.ones(len(hashes), dtype=bool)
            for probe in bloom_probes(hashes, bits):
                ok &= (filled[probe >> np.uint64(3)] >> (np.uint64(7) - (probe & np.uint64(7)))
                       .astype(np.uint8)) & 1 > 0
            return np.flatnonzero(ok)

        def work(batch):
            out, held = [], 0
            ids, keys = (batch.column(c).to_numpy() for c in ("id", "text_key"))
            for start, texts in blocks(batch.column("bytes").to_pylist()):
                c = contexts_of(texts, length)
                some = passes(c.anchors)
                if not len(some):
                    continue
                raw, first, last = b"".join(texts), c.first[some], c.last[some]
                pieces = [raw[a:b] for a, b in zip(first.tolist(), (last + length).tolist(),
                                                   strict=True)]
                signed, row = c.anchors[some].view(np.int64), start + c.text[some]
                if contents:
                    out.append((signed, c.offsets(some, length).astype(np.int32), pieces,
                                ids[row]))
                else:
                    out.append(([content_digest(h, p) for h, p in
                                 zip(signed.tolist(), pieces, strict=True)], ids[row],
                                keys[row], (first - c.starts[c.text[some]]).astype(np.int32),
                                (last - first + 1).astype(np.int32)))
                held += sum(map(len, pieces))
                if held > 1 << 23:
                    yield rows(out)
                    out, held = [], 0
            if out:
                yield rows(out)

        def rows(out):
            columns = [pa.array([x for part in c for x in part], pa.binary())
                       if isinstance(c[0], list) else pa.array(np.concatenate(c))
                       for c in zip(*out, strict=True)]
            kinds = CONTENTS if contents else PLACES
            return pa.RecordBatch.from_arrays(columns, [k.split()[0] for k in kinds.split(", ")])
        return work
    return per_batch(texts, CONTENTS if contents else PLACES, make)


VERDICT = "digest binary, starts array<int>, ids array<long>"


def runs_of(least: list[int]) -> tuple[list[int], list[int]]:
    """Starts and values of the runs of equal ids."""
    starts = [i for i, v in enumerate(least) if not i or v != least[i - 1]]
    return starts, [least[i] for i in starts]


PIECES = ("anchor long, at int, bytes binary, least long, most long, context binary, "
          "start int, low int, high int")


def halves(length: int, whole: bool):
    """Cuts pieces of contexts in two by where their strings hold the anchor.

    A piece has the strings that hold it after ``low`` to ``high`` bytes. All of them also
    hold ``low`` bytes before it and what ``high`` leaves behind it, which deals the piece
    on: equal strings hold the anchor at one place, so they meet again. ``whole`` takes
    contexts, as one piece each.
    """
    import xxhash

    def work(batch):
        out = []
        columns = [batch.column(n).to_pylist() for n in batch.schema.names]
        for anchor, at, content, least, most, *more in zip(*columns, strict=True):
            context, start, low, high = more or (content_digest(anchor, content), 0, 0,
                                                 length - GRAM)
            middle = (low + high + 1) // 2
            for a, b in ((low, middle - 1), (middle, high)):
                first, last = at - min(b, at), at - max(a, at - len(content) + length)
                if first <= last:
                    shared = content[at - a:at + length - b]
                    out.append((xxhash.xxh64_intdigest(shared, seed=a << 32 | b) - (1 << 63),
                                at - first, content[first:last + length], least, most, context,
                                start + first, a, b))
        kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
        columns = zip(*out, strict=True) if out else [[] for _ in PIECES.split(", ")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kinds[k.split()[1]]) for c, k in
             zip(columns, PIECES.split(", "), strict=True)],
            [k.split()[0] for k in PIECES.split(", ")])
    names = PIECES.split(", ")[:5] if whole else PIECES.split(", ")
    return [n.split()[0] for n in names], lambda: work


def decided_buckets(dealt: DataFrame, length: int) -> DataFrame:
    """Runs of smallest ids, by suffix arrays, for contexts or pieces of whole buckets."""
    names = [c for c in dealt.columns if c != "high"]
    high = dealt.columns.index("high") if "high" in dealt.columns else None

    def decide(batches):
        held = None
        for batch in batches:
            found = pa.Table.from_batches([batch])
            if held is not None:
                found = pa.concat_tables([held, found])
            anchors = found.column("anchor").to_numpy()
            # the last bucket may go on in the next batch
            ready = int(np.searchsorted(anchors, anchors[-1])) if len(anchors) else 0
            held = found.slice(ready)
            if ready:
                yield from buckets_of(found.slice(0, ready))
        if held is not None and held.num_rows:
            yield from buckets_of(held)

    def buckets_of(found):
        anchors = found.column("anchor").to_numpy()
        new = np.r_[True, anchors[1:] != anchors[:-1], True]
        lost = found.column("least").to_numpy() < found.column("most").to_numpy()
        # a content alone in its bucket matters only if a later document holds it too
        wanted = ~(new[:-1] & new[1:]) | lost
        out = []
        columns = found.filter(pa.array(wanted)).columns
        for anchor, same in groupby(zip(*(c.to_pylist() for c in columns), strict=True),
                                    key=lambda r: r[0]):
            grams: dict[bytes, list] = {}  # one, but for grams or shared bytes of equal hash
            for row in same:
                a, b = row[high - 1:high + 1] if high else (0, length - GRAM)
                grams.setdefault(row[2][row[1] - a:row[1] + length - b], []).append(row)
            for rows_of in grams.values():
                out += verdicts(anchor, rows_of)
            if len(out) >= 4096:
                yield packed(out)
                out = []
        if out:
            yield packed(out)

    def verdicts(anchor, same):
        if high:
            return verdicts_of_pieces(same)
        if len(same) == 1:
            _, _, content, least, most = same[0]
            return [(content_digest(anchor, content), [0], [least])] if least < most else []
        if min([r[3] for r in same]) == max([r[4] for r in same]):
            return []
        strings = least_ids([r[2] for r in same], [r[3] for r in same],
                            [r[1] for r in same], length)
        return [(content_digest(anchor, r[2]), *runs_of(s))
                for r, s in zip(same, strings, strict=True) if min(s) < r[4]]

    def verdicts_of_pieces(same):
        least: dict[tuple[bytes, int], int] = {}
        for r in same:
            least[r[2], r[1]] = min(r[3], least.get((r[2], r[1]), LAST_ID))
        if min(least.values()) == max([r[4] for r in same]):
            return []
        strings = dict(zip(least, least_ids([c for c, _ in least], list(least.values()),
                                            [at for _, at in least], length), strict=True))
        out = []
        for _, at, content, _, most, context, start, *_ in same:
            s = strings[content, at]
            if min(s) < most:
                starts, ids = runs_of(s)
                # nothing is said of the strings before and after the piece
                out.append((context, [start + i for i in starts] + [start + len(s)],
                            [*ids, LAST_ID]))
        return out

    def packed(out):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (
                pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())), strict=True)],
            ["digest", "starts", "ids"])
    return (dealt.repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(decide, VERDICT))


def parted(rows: DataFrame, bucket: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of buckets of at most ``bucket`` rows, and those of larger ones, if any."""
    large = fixed(rows.groupBy("anchor").agg(F.count("*").alias("n"))
                  .filter(F.col("n") > bucket).select("anchor"))
    n = large.count()
    if not n:
        return rows, None
    # one row for each ``bucket`` rows at most; sent to all tasks only if few
    hot = F.broadcast(large) if n <= HOT_ANCHORS else large
    return rows.join(hot, "anchor", "leftanti"), rows.join(hot, "anchor", "leftsemi")


def decided(contents: DataFrame, length: int, bucket: int, written: list[str]) -> DataFrame:
    """Runs of smallest ids for the strings of each content (digest).

    Contents of which no document can lose a byte are left out. Those of buckets of over
    ``bucket`` contexts come as several rows, one for each piece. The paths of tables that
    the result reads are added to ``written``.
    """
    few, many = parted(contents, bucket)
    found = decided_buckets(few, length)
    places, whole = length - GRAM + 1, True
    while many is not None and places > 1:
        names, make = halves(length, whole)
        pieces, path = materialise_at(per_batch(many.select(*names), PIECES, make), "pieces")
        written.append(path)
        few, many = parted(pieces, bucket)
        found = found.unionByName(decided_buckets(few, length))
        places, whole = (places + 1) // 2, False
    if many is None:
        return found
    # single strings by now, each in over ``bucket`` contexts: their ids meet in partial sums
    firsts = many.groupBy("bytes").agg(F.min("least").alias("first"))
    alone = many.join(firsts, "bytes").filter("first < most").select(
        F.col("context").alias("digest"), F.expr("array(start, start + 1)").alias("starts"),
        F.expr(f"array(first, {LAST_ID}L)").alias("ids"))
    return found.unionByName(alone)


def removed_runs(texts: DataFrame, length: int = LENGTH, bucket: int = BUCKET) -> DataFrame:
    """(id, text_key, runs): the byte runs [start, end) that each document loses.

    Every step is written before the next, and what it needed is then let go.
    """
    spark = texts.sparkSession
    shared, path = materialise_at(shared_anchors(texts, length), "shared-anchors")
    bloom = spark.sparkContext.broadcast(bloom_filter(shared))
    drop_path(spark, path)
    release(spark)
    contents, path = materialise_at(
        passing_contexts(texts, bloom, length, True).groupBy("anchor", "at", "bytes")
        .agg(F.min("id").alias("least"), F.max("id").alias("most")), "contexts")
    release(spark)
    written = [path]
    verdicts = materialise(decided(contents, length, bucket, written), "verdicts")
    for path in written:
        drop_path(spark, path)
    release(spark)
    places = passing_contexts(texts, bloom, length, False)
    # strings a to b - 1 of a context cover its bytes a to b - 2 + length
    return (places.join(verdicts, "digest")
            .select("id", "text_key", "first", "n", "starts", "ids",
                    F.posexplode("starts").alias("r", "a"))
            .filter("ids[r] < id")
            .select("id", "text_key", F.expr("first + a").alias("start"), F.expr(
                "first + if(r + 1 < size(starts), starts[r + 1], n)"
                f" - 1 + {length}").alias("end"))
            .groupBy("id", "text_key")
            .agg(F.collect_list(F.struct("start", "end")).alias("runs")))


REPORT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def byte_texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"),
                       F.xxhash64("text").alias("text_key"),
                       F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("bytes"))


def cut(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, int]:
    """What is left of ``raw`` without the runs, and the number of maximal removed runs."""
    if not len(starts):
        return raw, 0
    size = len(raw) + 1
    off = np.cumsum(np.bincount(starts, minlength=size) - np.bincount(ends, minlength=size))
    off = off[:-1] > 0
    spans = int(np.count_nonzero(off[1:] & ~off[:-1]) + off[0])
    return np.frombuffer(raw, np.uint8)[~off].tobytes(), spans


def substring_report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document: bytes, bytes and runs removed, digest of the bytes left."""
    texts = byte_texts(docs)
    runs = removed_runs(texts, length)
    keyed = texts.join(runs, ["id", "text_key"], "left").select("id", "bytes", "runs")

    def make():
        def work(batch):
            rows = []
            runs = batch.column("runs")
            upto = np.cumsum(pc.fill_null(pc.list_value_length(runs), 0).to_numpy())
            starts, ends = (runs.flatten().field(k).to_numpy() for k in (0, 1))
            for ident, raw, b, n in zip(batch.column("id").to_pylist(),
                                        batch.column("bytes").to_pylist(), upto.tolist(),
                                        np.diff(upto, prepend=0).tolist(), strict=True):
                left, spans = cut(raw, starts[b - n:b], ends[b - n:b])
                rows.append((None if ident == LAST_ID else ident, len(raw),
                             len(raw) - len(left), spans, hashlib.sha256(left).hexdigest()))
            names = [c.split()[0] for c in REPORT.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string() if n == "kept_sha256" else pa.int64())
                 for n, c in zip(names, zip(*rows, strict=True), strict=True)], names)
        return work
    return per_batch(keyed, REPORT, make)
