"""Packed token matrices by best-fit decreasing.

Documents become token ids; a document longer than a row is split losslessly
into full rows and a rest. Pieces are packed, longest first, each into the row
with the least room that still holds it; that row is found by descending a
segment tree over the rooms 0..capacity, which counts the open rows of each room.

A task packs the pieces of its own partition in windows of about
``window_tokens`` ids, so nothing is shuffled, memory is bounded and only a
window's last rows are partly empty. Rows hold the ids in the smallest
unsigned type that fits the vocabulary, padded with zeros; cumulative segment
lengths tell padding from ids, and every segment's start resets the position.

The default ids are those of the public word-level vocabulary, tokenised here;
``byte_ids`` takes the text's UTF-8 bytes instead (a vocabulary of 256). A row's number
holds its task and its number in the task: unique, and the same again only for an input
that is split alike. Null and empty
texts have no ids: each gives an empty piece, in a row of its own window, so no
document is lost. Rows that repeat a document are packed as often as they occur.
Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import kept_in_worker, texts_of

ROW_TOKENS = 8192
WINDOW_TOKENS = 1 << 22
WORD_VOCABULARY = 49408


Encoder = Callable[[list[str]], Iterable[np.ndarray]]


def byte_ids() -> Encoder:
    """Encoder of texts as their UTF-8 bytes; use with a vocabulary of 256."""
    return lambda texts: (np.frombuffer(t.encode(), dtype=np.uint8) for t in texts)


def word_ids() -> Encoder:
    """The default encoder: ids of the public word-level vocabulary (``WORD_VOCABULARY``)."""
    from .bpe import WordBpe, WordIds, vocabulary_text
    return kept_in_worker(("word-ids",), lambda: WordIds(WordBpe(vocabulary_text())))


class Rooms:
    """Open rows by the room left in them; a segment tree finds the tightest fit."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def add(self, room: int, row: int) -> None:
        self.rows.setdefault(room, []).append(row)
        self._change(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(row, its room) with the smallest room of ``least`` or more, removed."""
        room = self._first(least)
        if room is None:
            return None
        self._change(room, -1)
        return self.rows[room].pop(), room

    def _change(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def _first(self, least: int) -> int | None:
        node = least + self.leaves
        if self.count[node]:
            return least
        # climb until a right sibling holds rows, then descend to its smallest room
        while node > 1:
            if not node & 1 and self.count[node + 1]:
                node += 1
                break
            node >>= 1
        else:
            return None
        while node < self.leaves:
            node = 2 * node if self.count[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows of piece numbers; every length is at most ``capacity``."""
    rooms, rows = Rooms(capacity), []
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = rooms.take(lengths[piece])
        if found is None:
            row, room = len(rows), capacity
            rows.append([])
        else:
            row, room = found
        rows[row].append(piece)
        rooms.add(room - lengths[piece], row)
    return rows


PACKED = ("row_id long, ids binary, n_tokens int, cu_seqlens array<int>, "
          "position_resets array<int>, doc_ids array<long>, pieces array<int>")


def pack(docs: DataFrame, row_tokens: int = ROW_TOKENS, window_tokens: int = WINDOW_TOKENS,
         encoder: Callable[[], Encoder] = word_ids,
         vocabulary: int = WORD_VOCABULARY) -> DataFrame:
    """One row per packed matrix row: ids, segment ends, position resets and origins."""
    kind = np.dtype("<u1" if vocabulary <= 1 << 8 else "<u2" if vocabulary <= 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        base, made = TaskContext.get().partitionId() << 32, 0
        window, held = [], 0
        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode(texts_of(batch)),
                                strict=True):
                ids = ids.astype(kind, copy=False)
                cuts = range(0, max(len(ids), 1), row_tokens)
                window += [(doc, n, ids[a:a + row_tokens]) for n, a in enumerate(cuts)]
                held += len(ids) + 1
                if held >= window_tokens:
                    for rows in packed(window, base + made):
                        made += rows.num_rows
                        yield rows
                    window, held = [], 0
        yield from packed(window, base + made)

    def packed(window, first: int) -> Iterator[pa.RecordBatch]:
        rows = best_fit_decreasing([len(p[2]) for p in window], row_tokens)
        for start in range(0, len(rows), 64):
            out = []
            for n, row in enumerate(rows[start:start + 64], start):
                parts = [window[i] for i in row]
                matrix = np.zeros(row_tokens, dtype=kind)
                ends = np.cumsum([len(p[2]) for p in parts])
                total = int(ends[-1])
                matrix[:total] = np.concatenate([p[2] for p in parts])
                cu = [0, *ends.tolist()]
                out.append((first + n, matrix.tobytes(), total, cu, cu[:-1],
                            [p[0] for p in parts], [p[1] for p in parts]))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (
                    pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int32()),
                    pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32())),
                    strict=True)],
                ["row_id", "ids", "n_tokens", "cu_seqlens", "position_resets",
                 "doc_ids", "pieces"])
    return docs.select("doc_id", "text").mapInArrow(run, PACKED)


def write_packed(docs: DataFrame, path: str, **options) -> DataFrame:
    """Write the packed matrices as Parquet under ``path`` and return the written table."""
    pack(docs, **options).write.parquet(path)
    return docs.sparkSession.read.parquet(path)
