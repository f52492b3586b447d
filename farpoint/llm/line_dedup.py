"""Line dedup by winnowing over line hashes.

A document is the sequence of its lines that hold a word, each compared without
the white space around it. Every window of ``window`` lines selects the position
of its smallest line hash (the rightmost of equals), so each run of at least
``window`` lines that occurs twice selects equal positions in both places: the
guaranteed fingerprints. Fingerprints met once are dropped. The other positions
are extended both ways to the windows that selected them, equal windows are
joined, and every window but the first of its kind, by (doc_id, position), is
deleted; overlapping windows make up the whole repeated run. So a line goes if
and only if it lies in a run of ``window`` lines that also starts earlier, in
an earlier document or higher up in the same one.

With ``long_words``, every line of at least that many words is a run of its own as
well: it goes wherever it stands earlier, also between differing lines or as the only
line of its document. Without it (the rule of op6's SQL) such a line stays.

Equal keys are counted before they are shuffled and no pair of occurrences is
ever listed, so a line or run that a third of all documents share costs one row
for each place where it stands. Lines are compared by two 64-bit hashes.

Null texts are empty. Lines without a word are never compared and stay. Null ids
come last. Rows that repeat a doc_id and text are one document: they get the
same result. Documents shorter than the window stay whole, but for their long lines;
empty tables give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LAST_ID, SPACES, WORD, fixed, per_batch, texts_of, with_row

WINDOW = 2
LONG_WORDS = 50


def line_hashes(text: str) -> np.ndarray:
    """128-bit hashes, as pairs of signed longs, of the lines that hold a word."""
    import xxhash

    stripped = (line.strip(SPACES) for line in text.split("\n"))
    raw = b"".join([xxhash.xxh3_128_digest(s.encode()) for s in stripped if s])
    return np.frombuffer(raw, dtype="<i8").reshape(-1, 2)


def selected_starts(first: np.ndarray, window: int) -> np.ndarray:
    """For every window start, the position of the window's (rightmost) smallest hash."""
    if len(first) < window:
        return np.empty(0, np.int64)
    spans = np.lib.stride_tricks.sliding_window_view(first, window)
    return np.arange(len(spans)) + window - 1 - spans[:, ::-1].argmin(axis=1)


def long_lines(text: str, words: int) -> np.ndarray:
    """Positions, among the lines that hold a word, of those with at least ``words``."""
    counts = [len(WORD.findall(line)) for line in text.split("\n")]
    return np.flatnonzero(np.array([n for n in counts if n], dtype=np.int64) >= words)


WINDOWS = "id long, text_key long, start int, lines int, fingerprint long, content binary"


def windows(docs: DataFrame, window: int, long_words: int | None = None) -> DataFrame:
    """One row per window: its document, start, length, selected fingerprint and content hash.

    A long line is a window of one line; its fingerprint is its other hash, so that it
    meets long lines only.
    """
    def make():
        import xxhash

        def work(batch):
            ids, keys = batch.column("id").to_numpy(), batch.column("text_key").to_numpy()
            out = [[], [], [], [], [], []]
            for i, text in enumerate(texts_of(batch)):
                hashes = line_hashes(text)
                place = selected_starts(hashes[:, 0], window)
                alone = long_lines(text, long_words) if long_words and window > 1 else place[:0]
                n, m = len(place), len(alone)
                if not n + m:
                    continue
                raw = hashes.tobytes()
                out[0].append(np.full(n + m, ids[i]))
                out[1].append(np.full(n + m, keys[i]))
                out[2].append(np.r_[np.arange(n), alone].astype(np.int32))
                out[3].append(np.repeat(np.array([window, 1], np.int32), [n, m]))
                out[4].append(np.r_[hashes[place, 0], hashes[alone, 1]])
                out[5] += [xxhash.xxh3_128_digest(raw[16 * s:16 * (s + window)])
                           for s in range(n)]
                out[5] += [xxhash.xxh3_128_digest(raw[16 * s:16 * (s + 1)])
                           for s in alone.tolist()]
            if out[5]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in out[:5]]
                    + [pa.array(out[5], pa.binary())],
                    ["id", "text_key", "start", "lines", "fingerprint", "content"])
        return work
    return per_batch(docs, WINDOWS, make)


def repeated_starts(docs: DataFrame, window: int = WINDOW,
                    long_words: int | None = None) -> DataFrame:
    """(id, text_key, starts): the starts of every document's later repeated windows.

    A long line at position p that is repeated alone is listed as -1 - p.
    """
    keyed = docs.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"),
                        F.xxhash64("text").alias("text_key"), "text")
    seen = fixed(windows(keyed, window, long_words))
    # positions where equal fingerprints were selected more than once
    shared = (seen.groupBy("fingerprint").agg(F.count("*").alias("n"))
              .filter("n > 1").select("fingerprint"))
    seeds = seen.join(shared, "fingerprint", "leftsemi")
    place = F.struct("id", "text_key", "start")
    # the first of each kind of extended window; the others are repeats
    firsts = (seeds.groupBy("content").agg(F.min(place).alias("first"), F.max(place).alias("last"))
              .filter("first != last").select("content", "first"))
    again = (seen.join(firsts, "content")
             .filter((F.col("id") > F.col("first.id"))
                     | ((F.col("id") == F.col("first.id"))
                        & (F.col("text_key") == F.col("first.text_key"))
                        & (F.col("start") > F.col("first.start")))
                     | ((F.col("id") == F.col("first.id"))
                        & (F.col("text_key") > F.col("first.text_key")))))
    start = F.when(F.col("lines") < window, -1 - F.col("start")).otherwise(F.col("start"))
    return again.groupBy("id", "text_key").agg(F.collect_set(start).alias("starts"))


def without_runs(text: str, starts, window: int) -> tuple[str, int, int, int]:
    """The text without the lines of its repeated runs; lines with a word, removed, runs."""
    lines = text.split("\n")
    worded = [i for i, line in enumerate(lines) if line.strip(SPACES)]
    gone = np.zeros(len(worded) + 1, dtype=bool)
    for s in starts if starts is not None else ():
        if s < 0:
            gone[-1 - s] = True
        else:
            gone[s:s + window] = True
    runs = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0])
    drop = {worded[i] for i in np.flatnonzero(gone)}
    kept = "\n".join([line for i, line in enumerate(lines) if i not in drop]) if drop else text
    return kept, len(worded), len(drop), runs


def _with_starts(docs: DataFrame, window: int, long_words: int | None) -> DataFrame:
    found = repeated_starts(docs, window, long_words)
    rows = with_row(docs, F.coalesce(F.col("doc_id"), F.lit(LAST_ID)).alias("id"),
                    F.xxhash64("text").alias("text_key"))
    return rows.join(found, ["id", "text_key"], "left").select("row", "starts")


def dedup_lines(docs: DataFrame, window: int = WINDOW,
                long_words: int | None = None) -> DataFrame:
    """All documents and columns; ``text`` without its later repeated runs.

    ``n_chars``, where the input has it, becomes the new length of a changed text.
    """
    place = docs.columns.index("text")
    count = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def make():
        def work(batch):
            row, starts = batch.column("row"), batch.column("starts").to_pylist()
            columns = row.flatten()
            old = columns[place].to_pylist()
            new = [without_runs(t, s, window)[0] if t and s else t
                   for t, s in zip(old, starts, strict=True)]
            columns[place] = pa.array(new, columns[place].type)
            if count is not None:
                kept = columns[count].to_pylist()
                columns[count] = pa.array(
                    [len(b) if a != b else n for a, b, n in zip(old, new, kept, strict=True)],
                    columns[count].type)
            yield pa.RecordBatch.from_arrays(columns, names)
        return work
    names = docs.columns
    return per_batch(_with_starts(docs, window, long_words), docs.schema, make)


REPORT = "doc_id long, n_lines long, n_removed long, n_runs long, kept_sha256 string"


def line_report(docs: DataFrame, window: int = WINDOW,
                long_words: int | None = None) -> DataFrame:
    """Per document: lines with a word, lines and runs removed, digest of what is left."""
    def make():
        def work(batch):
            ids, texts = batch.column("row").flatten()
            found = [without_runs(t or "", s, window) for t, s in
                     zip(texts.to_pylist(), batch.column("starts").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pc.cast(ids, pa.int64())] + [pa.array([f[i] for f in found], pa.int64())
                                              for i in (1, 2, 3)]
                + [pa.array([hashlib.sha256(f[0].encode()).hexdigest() for f in found])],
                ["doc_id", "n_lines", "n_removed", "n_runs", "kept_sha256"])
        return work
    return per_batch(_with_starts(docs.select("doc_id", "text"), window, long_words),
                     REPORT, make)
