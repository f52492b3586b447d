"""Cross-tokenizer alignment by as-of merges of token offsets, keyed by document.

Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B (pieces with byte
fallback) the text, before which it puts that space itself. Both then tile the same
bytes. Per batch, ``pandas.merge_asof`` runs in both directions, keyed by document: the
start of every A token finds the B token that covers it, and the other way round. The
union of both are the overlapping pairs (links); byte offsets where tokens of both sides
end cut them into groups.

How often an id pair is linked in the whole corpus takes a second step. Documents lie in
runs of about ``RUN_BYTES``; a run sends its distinct pairs with their counts, so a pair
that every document holds is one row for each run. The corpus counts come back to the
runs that hold the pair, and each run sums them up by document.

Both tokenizers cut before a blank that follows a character other than white space: A's
splitting pattern does, and no piece of B holds such a blank. So texts are encoded chunk
by chunk, chunks seen before come from a bounded cache, and a text of any length is
aligned in slices of ``SLICE`` chunks. A vocabulary whose pieces break this is refused.

Null and empty texts, and texts whose tokens do not give the bytes back on both sides
(as with U+2581, B's sign for a blank), have no tokens: zeros and an empty digest.
Every input row gives one row, repeated rows alike; their links count as often as they
stand. Columns besides doc_id and text are not read. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise_at
from .bpe import byte_symbols
from .common import kept_in_worker

RUN_BYTES, PIECE_BYTES, SLICE = 4 << 20, 1 << 19, 1 << 16
CACHE_CHUNKS, BLOCK_CHARS = 400_000, 1 << 16
BLANK = "\u2581"
_SPACE = "\\s\u180e\u200b\ufeff"        # all that either side may take for white space
CUT = re.compile(f"(?<=[^{_SPACE}]) ")
SPACED = re.compile(f"[{_SPACE}] ")
ENDS_OPEN = re.compile(f"(?:^|[{_SPACE}])\\Z")


def chunks(text: str) -> list[str]:
    """The parts of space + text between certain cuts, each without its first blank."""
    if text[0] == " " or SPACED.search(text):
        return CUT.split(text)
    return text.split(" ")


class Aligner:
    """Both vocabularies, and the tokens of chunks seen before."""

    def __init__(self, a_spec: str, b_model: bytes, cache_chunks: int = CACHE_CHUNKS):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_spec)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_model)
        byte = {s: b for b, s in byte_symbols().items()}
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [bytes([byte[c] for c in names[i]])
                        if i in names and all(c in byte for c in names[i]) else b""
                        for i in range(max(names) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError("a piece holds a blank after another character")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i)
                        else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.lone_blank = [self.b.piece_to_id(BLANK)]
        self.size = [np.array([len(t) for t in side], dtype=np.int64)
                     for side in (self.a_bytes, self.b_bytes)]
        self.written = [np.array([[mark + str(i) for i in range(len(side))]
                                  for mark in marks], dtype=object)
                        for side, marks in ((self.a_bytes, ",;"), (self.b_bytes, ",|"))]
        self.cache_chunks = cache_chunks
        self.forget()

    def forget(self) -> None:
        self.code, self.fine = {}, np.empty(0, bool)
        self.ids = [np.empty(0, np.int32), np.empty(0, np.int32)]
        self.count = [np.empty(0, np.int64), np.empty(0, np.int64)]
        self.first = [np.empty(0, np.int64), np.empty(0, np.int64)]

    def encode_block(self, parts: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Both sides' ids and their number for every part, from one call each.

        None if the bytes don't come back.
        """
        joined = " ".join(parts)
        raw = b" " + joined.encode()
        size = [len(p) for p in parts] if len(raw) == len(joined) + 1 else \
            [len(p.encode()) for p in parts]
        upto = np.cumsum(np.array(size) + 1)
        out = []
        for side, ids in enumerate((self.a.encode(" " + joined, add_special_tokens=False).ids,
                                    self.b.encode(joined))):
            table = (self.a_bytes, self.b_bytes)[side]
            if b"".join(map(table.__getitem__, ids)) != raw:
                return None
            ids = np.array(ids, dtype=np.int32)
            ends = np.cumsum(self.size[side][ids])
            cut = np.searchsorted(ends, upto)
            if (ends[cut] != upto).any():
                return None
            out.append((ids, np.diff(cut, prepend=-1)))
        return out

    def encode_part(self, part: str) -> tuple[list[int], list[int], bool]:
        """Both sides' ids of one part on its own, and whether they give its bytes back."""
        raw = b" " + part.encode()
        a = self.a.encode(" " + part, add_special_tokens=False).ids
        b = self.b.encode(part) if part else self.lone_blank
        return a, b, (b"".join([self.a_bytes[i] for i in a]) == raw
                      and b"".join([self.b_bytes[i] for i in b]) == raw)

    def learn(self, parts: list[str]) -> None:
        """Encode parts not seen before and remember their tokens."""
        alone = [p for p in parts if ENDS_OPEN.search(p)]
        rest = [p for p in parts if not ENDS_OPEN.search(p)] if alone else parts
        if rest:
            upto = np.cumsum([len(p) for p in rest])
            cuts = np.searchsorted(upto, np.arange(0, upto[-1], BLOCK_CHARS)).tolist()
            for low, high in zip(cuts, [*cuts[1:], len(rest)], strict=True):
                block = rest[low:high]
                both = self.encode_block(block) if block else None
                if both is None:
                    alone += block
                else:
                    self.remember(block, both, np.ones(len(block), bool))
        if alone:
            found = [self.encode_part(p) for p in alone]
            self.remember(alone, [
                (np.array([i for f in found for i in f[side]], np.int32),
                 np.array([len(f[side]) for f in found], np.int64)) for side in (0, 1)],
                np.array([f[2] for f in found], bool))

    def remember(self, parts: list[str], both: list[tuple[np.ndarray, np.ndarray]],
                 fine: np.ndarray) -> None:
        self.code.update(zip(parts, range(len(self.code), len(self.code) + len(parts)),
                             strict=True))
        self.fine = np.r_[self.fine, fine]
        for side, (ids, count) in enumerate(both):
            start = len(self.ids[side]) + np.cumsum(count) - count
            self.ids[side] = np.r_[self.ids[side], ids]
            self.count[side] = np.r_[self.count[side], count]
            self.first[side] = np.r_[self.first[side], start]

    def codes(self, parts: list[str]) -> np.ndarray:
        new = set(parts).difference(self.code)
        if new:
            if len(self.code) + len(new) > self.cache_chunks:
                self.forget()
                new = set(parts)
            self.learn(sorted(new))
        return np.fromiter(map(self.code.__getitem__, parts), np.int64, len(parts))

    def tokens(self, codes: np.ndarray, doc: np.ndarray, side: int) -> pd.DataFrame:
        """doc, start, end and id of every token of the chunks, in order."""
        count = self.count[side][codes]
        upto = np.cumsum(count)
        place = np.repeat(self.first[side][codes] - upto + count, count) + np.arange(upto[-1])
        ids = self.ids[side][place]
        size = self.size[side][ids]
        end = np.cumsum(size)
        return pd.DataFrame({"start": end - size, "doc": np.repeat(doc, count),
                             "end": end, "id": ids.astype(np.int64),
                             "n": np.arange(len(ids))}, copy=False)


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rows of all A and B tokens of one document whose byte ranges overlap.

    Every start finds the other side's covering token, the last one that does not start
    later; a pair with equal starts is found both ways and kept once.
    """
    under = pd.merge_asof(a[["start", "doc"]], b[["start", "doc", "n"]], on="start", by="doc")
    above = pd.merge_asof(b[["start", "doc"]], a[["start", "doc", "n"]], on="start", by="doc")
    b_of, a_of = under["n"].to_numpy(np.int64), above["n"].to_numpy(np.int64)
    twice = a["start"].to_numpy()[a_of] == b["start"].to_numpy()
    return np.r_[np.arange(len(a)), a_of[~twice]], np.r_[b_of, np.flatnonzero(~twice)]


class _Run:
    """The aligned documents of one run."""

    def __init__(self):
        self.docs, self.counts, self.digests = [], [], []
        self.links, self.of = [], []
        self.size = 0

    def add(self, doc_id: int | None, digest: str) -> int:
        self.docs.append(doc_id)
        self.digests.append(digest)
        self.counts.append(np.zeros(4, np.int64))
        return len(self.docs) - 1

    def row(self, number: int) -> pa.RecordBatch:
        links = np.concatenate([np.empty(0, np.int64), *self.links])
        of = np.concatenate([np.empty(0, np.int64), *self.of])
        pairs, code, n = np.unique(links, return_inverse=True, return_counts=True)
        held, times = np.unique(of * max(len(pairs), 1) + code, return_counts=True)
        each = np.bincount(held // max(len(pairs), 1), minlength=len(self.docs))
        count = np.array(self.counts).reshape(-1, 4)
        one = lambda v, t: pa.array([v], pa.list_(t))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), one(self.docs, pa.int64()),
             *[one(count[:, i], pa.int64()) for i in range(4)],
             one(self.digests, pa.string()), one(each.astype(np.int64), pa.int64()),
             pa.array([(held % max(len(pairs), 1)).astype("<i4").tobytes()], pa.binary()),
             pa.array([times.astype("<i4").tobytes()], pa.binary()),
             one(pairs, pa.int64()), one(n.astype(np.int64), pa.int64())],
            ["run", "docs", "n_a", "n_b", "n_groups", "n_links", "digests", "held",
             "codes", "times", "pairs", "counts"])


RUNS = ("run long, docs array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
        "n_links array<long>, digests array<string>, held array<long>, codes binary, "
        "times binary, pairs array<long>, counts array<long>")


def align(aligner: Aligner, run: _Run, texts: list[tuple[int | None, str]]) -> None:
    """Align some documents and add them to the run."""
    parts = [chunks(t) if t else [] for _, t in texts]
    codes = aligner.codes([p for found in parts for p in found])
    start = 0
    kept, owner, hashes = [], [], {}
    for (doc_id, _), found in zip(texts, parts, strict=True):
        mine = codes[start:start + len(found)]
        start += len(found)
        place = run.add(doc_id, "")
        if len(mine) and aligner.fine[mine].all():
            kept.append(mine)
            owner.append(np.full(len(mine), place))
            hashes[place] = hashlib.sha256()
    if not kept:
        return
    kept, owner = np.concatenate(kept), np.concatenate(owner)
    for at in range(0, len(kept), SLICE):
        _align_slice(aligner, run, kept[at:at + SLICE], owner[at:at + SLICE], hashes)
    for place, digest in hashes.items():
        run.digests[place] = digest.hexdigest()


def _align_slice(aligner: Aligner, run: _Run, codes: np.ndarray, owner: np.ndarray,
                 hashes: dict) -> None:
    a, b = (aligner.tokens(codes, owner, side) for side in (0, 1))
    row_a, row_b = overlaps(a, b)
    id_a, id_b = a["id"].to_numpy(), b["id"].to_numpy()
    doc_a, doc_b = a["doc"].to_numpy(), b["doc"].to_numpy()
    run.links.append(id_a[row_a] << 32 | id_b[row_b])
    run.of.append(doc_a[row_a])

    both = np.intersect1d(a["end"].to_numpy(), b["end"].to_numpy(), assume_unique=True)
    group_a, group_b = (np.searchsorted(both, t["end"].to_numpy()) for t in (a, b))
    first_a = np.r_[True, group_a[1:] != group_a[:-1]]
    first_b = np.r_[True, group_b[1:] != group_b[:-1]]
    b_before = np.searchsorted(group_b, group_a)             # B tokens of earlier groups
    a_upto = np.searchsorted(group_a, group_b, "right")      # A tokens up to this group
    text = np.empty(len(a) + len(b), dtype=object)
    text[np.arange(len(a)) + b_before] = aligner.written[0][first_a.astype(int), id_a]
    text[np.arange(len(b)) + a_upto] = aligner.written[1][first_b.astype(int), id_b]

    text = text.tolist()
    new = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    places = owner[new]
    upto = [np.searchsorted(d, places, "right") for d in (doc_a, doc_b)]
    count = np.stack([np.bincount(d, minlength=places[-1] + 1)[places] for d in
                      (doc_a, doc_b, doc_a[first_a], run.of[-1])], axis=1)
    low = 0
    for place, high, n in zip(places.tolist(), (upto[0] + upto[1]).tolist(), count, strict=True):
        written = "".join(text[low:high])
        low = high
        # the first group of a document has no mark before it
        hashes[place].update((written if run.counts[place][0] else written[1:]).encode())
        run.counts[place] += n


def runs(docs: DataFrame, a_spec: str, b_model: bytes) -> DataFrame:
    """Runs of aligned documents with the run's distinct id pairs."""
    shared = docs.sparkSession.sparkContext.broadcast((a_spec, b_model))
    name = hashlib.sha256(a_spec.encode() + b_model).hexdigest()

    def pieces(batches) -> Iterator[list[tuple[int | None, str]]]:
        for batch in batches:
            held, size = [], 0
            for doc_id, text in zip(pc.cast(batch.column("doc_id"), pa.int64()).to_pylist(),
                                    batch.column("text").to_pylist(), strict=True):
                held.append((doc_id, text or ""))
                size += len(text or "")
                if size >= PIECE_BYTES:
                    yield held
                    held, size = [], 0
            if held:
                yield held

    def work(batches):
        aligner = kept_in_worker(("aligner", name), lambda: Aligner(*shared.value))
        context = TaskContext.get()
        number, run = (context.partitionId() if context else 0) << 32, _Run()
        for piece in pieces(batches):
            align(aligner, run, piece)
            run.size += sum(len(t) for _, t in piece)
            if run.size >= RUN_BYTES:
                yield run.row(number)
                number, run = number + 1, _Run()
        if run.docs:
            yield run.row(number)
    return docs.select("doc_id", "text").mapInArrow(work, RUNS)


REPORT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
          "count_sum long, groups_sha256 string")


def _report(run: pa.Table, known: pa.Table) -> pa.Table:
    """The rows of one run's documents, with the corpus counts of its pairs."""
    out = pa.schema([(n, pa.string() if n == "groups_sha256" else pa.int64()) for n in
                     ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                      "groups_sha256")])
    if not run.num_rows:
        return out.empty_table()
    column = lambda n: run.column(n).combine_chunks().flatten()
    order = np.argsort(known.column("code").to_numpy())
    count = known.column("n").to_numpy()[order]
    best = known.column("best").to_numpy()[order]
    codes, times = (np.frombuffer(run.column(n)[0].as_buffer(), dtype="<i4")
                    for n in ("codes", "times"))
    held = column("held").to_numpy()
    upto = np.cumsum(held)
    sums = []
    for value in (best.astype(np.int64), count):
        total = np.r_[0, np.cumsum(value[codes] * times)] if len(codes) else np.zeros(1, np.int64)
        sums.append(total[upto] - total[upto - held])
    return pa.Table.from_arrays(
        [column("docs"), *[column(n) for n in ("n_a", "n_b", "n_groups", "n_links")],
         pa.array(sums[0]), pa.array(sums[1]), column("digests")], schema=out)


def vocabulary_files(a_path: str | None = None, b_path: str | None = None) -> tuple[str, bytes]:
    """Both files' contents; by default the public byte-level and piece vocabularies."""
    if a_path is None or b_path is None:
        import public_tokenizers
        a_path = a_path or public_tokenizers.path("byte_bpe_50k.json")
        b_path = b_path or public_tokenizers.path("piece_bpe_32k.model")
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return a.read(), b.read()


def pair_counts(local: DataFrame) -> DataFrame:
    """(pair, n, best): corpus count of every id pair, and whether no pair of its B id has more."""
    pairs = local.groupBy("pair").agg(F.sum("n").alias("n"))
    most = pairs.groupBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b")).agg(
        F.max("n").alias("most"))
    return (pairs.join(most, F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)) == F.col("b"))
            .select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def align_report(docs: DataFrame, a_path: str | None = None,
                 b_path: str | None = None) -> DataFrame:
    """Per document: token, group and link counts, links to best partners, digest of groups."""
    found, _ = materialise_at(runs(docs, *vocabulary_files(a_path, b_path)), "aligned-runs")
    local = found.select(F.col("run").alias("of_run"),
                         F.posexplode(F.arrays_zip("pairs", "counts")).alias("code", "p")).select(
        "of_run", "code", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    known = local.drop("n").join(pair_counts(local), "pair").select("of_run", "code", "n", "best")
    return (found.drop("pairs", "counts").groupBy("run")
            .cogroup(known.groupBy("of_run")).applyInArrow(_report, REPORT))
