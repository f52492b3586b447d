"""Cross-tokenizer alignment against the libraries on whole texts and a plain double loop."""

import hashlib
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from farpoint.llm import alignment as op

SCHEMA = "doc_id long, text string, run string, code int, pairs int"
ODD = ["", None, " ", "  ", "a", "a ", "a  b", "\n", " \n x", "x\n\n y  z \t q", "a  b",
       "a b", "▁x", "a ▁", "<|endoftext|> a <s> b", "日本 語 　 x", "é ﻿ x",
       "!\x1c x\x1c \x1d y", "a\x00 b", "'s don't we'll  1234 ½ ²", "᠎ x", "👍🏽 ok 👍",
       "\r\n x", " x" * 3000, "word " * 9000]


def some_texts(n=120):
    rnd = random.Random(4)
    parts = ["a", "bc", " ", "  ", "\n", "!", "'s", "9", "é", "日", " ", "\x1c", "\x85",
             "﻿", "<s>", "👍", "foo", " the", " of", " être"]
    return ODD + ["".join(rnd.choices(parts, k=rnd.randint(1, 40))) for _ in range(n)] + ODD[:9]


@pytest.fixture(scope="module")
def sides():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    spec, model = op.vocabulary_files()
    a = Tokenizer.from_str(spec)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_proto=model), op.Aligner(spec, model)


def token_bytes_b(b, i):
    piece = b.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()


def brute(text, sides):
    """ids and byte ranges of both sides by the libraries, links and groups by plain loops."""
    a, b, aligner = sides
    if not text:
        return [], "", 0, 0, 0
    ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text))
    raws = ([aligner.a_bytes[i] for i in ids[0]], [token_bytes_b(b, i) for i in ids[1]])
    if any(b"".join(r) != (" " + text).encode() for r in raws):
        return [], "", 0, 0, 0
    ends = [np.cumsum([len(x) for x in r]) for r in raws]
    starts = [e - [len(x) for x in r] for e, r in zip(ends, raws, strict=True)]
    links = []
    for i in range(len(ids[0])):
        meets = np.flatnonzero((starts[1] < ends[0][i]) & (ends[1] > starts[0][i]))
        links += [(ids[0][i], ids[1][j]) for j in meets]
    groups, low = [], 0
    for end in sorted(set(ends[0].tolist()) & set(ends[1].tolist())):
        groups.append("|".join(",".join(str(i) for i, e in zip(ids[s], ends[s], strict=True)
                                        if low < e <= end) for s in (0, 1)))
        low = end
    digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
    return links, digest, len(ids[0]), len(ids[1]), len(groups)


@pytest.mark.parametrize("run_bytes,piece_bytes,size", [
    (op.RUN_BYTES, op.PIECE_BYTES, op.SLICE), (3000, 700, 23)])
def test_report_equals_brute_force(spark, sides, monkeypatch, run_bytes, piece_bytes, size):
    monkeypatch.setattr(op, "RUN_BYTES", run_bytes)
    monkeypatch.setattr(op, "PIECE_BYTES", piece_bytes)
    monkeypatch.setattr(op, "SLICE", size)
    monkeypatch.setattr(op, "kept_in_worker", lambda key, make: make())
    texts = some_texts()
    rows = [(None if i == 7 else i // 2, t, "r", 1, 2) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = Counter(tuple(r) for r in op.align_report(docs).collect())
    found = [brute(t, sides) for t in texts]
    count = Counter(link for f in found for link in f[0])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(n, most.get(b, 0))
    want = Counter((doc_id, n_a, n_b, n_groups, len(links),
                    sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
                    digest) for (doc_id, *_), (links, digest, n_a, n_b, n_groups)
                   in zip(rows, found, strict=True))
    assert got == want and sum(bool(f[0]) for f in found) > 100


def test_a_small_cache_gives_the_same_tokens(sides):
    spec, model = op.vocabulary_files()
    small, run, same = op.Aligner(spec, model, 30), op._Run(), op._Run()
    texts = [(i, t or "") for i, t in enumerate(some_texts(40))]
    for some in texts:
        op.align(small, run, [some])
    op.align(sides[2], same, texts)
    assert run.digests == same.digests


def test_overlaps_of_planted_tokens():
    frame = lambda starts: pd.DataFrame(
        {"start": starts, "doc": np.int64([0] * len(starts)), "n": range(len(starts))})
    a, b = op.overlaps(frame([0, 2, 5]), frame([0, 1, 4, 5]))
    assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == [
        (0, 0), (0, 1), (1, 1), (1, 2), (2, 3)]


def test_empty_table(spark):
    assert op.align_report(spark.createDataFrame([], SCHEMA)).collect() == []
    found = op.align_report(spark.createDataFrame([(1, None, "", 0, 0)], SCHEMA)).collect()
    assert [tuple(r) for r in found] == [(1, 0, 0, 0, 0, 0, 0, "")]
