"""Quality classifier trained from weak labels.

Several overlapping heuristics vote on each document: good, bad or no opinion.
Votes of all documents are counted by pattern (eight votes of three values: at
most 6561 patterns, whatever the corpus), and expectation-maximisation on those
counts estimates how often each labeller votes what on good and on bad documents,
and the share of good ones. A pattern's posterior is its documents' weak label.

The posteriors train a hashed linear scorer: logistic regression on word and
word-shape counts hashed into ``2**HASH_BITS`` weights, fitted by MLlib on a
sample of at most about ``SAMPLE_ROWS`` documents, drawn by a 64-bit hash of id and text
(the documented bound). Rows equal in both are one document of the sample, weighted by
their number; a draw of under half the documents is widened, so repeated rows never
leave it empty. The scorer, not the vote, gives every document's verdict.

Null and blank texts have no words, get only the votes of the length rule and a
score from the intercept. Documents are scored one by one, so ties and repeated
rows get equal results. Where the sample holds only one weak class, the scorer is
the posterior itself. Empty tables give no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fixed, per_batch, texts_of
from .quality_rules import Signals

HASH_BITS = 16
SAMPLE_ROWS = 10_000
GOOD, BAD, NONE = 1, 0, 2
KEEP_FROM = 0.4
# A draw that is too small is made so many times wider at most.
WIDEN = 16


def vote(value: float, good_upto: float, bad_from: float) -> int:
    return GOOD if value <= good_upto else BAD if value >= bad_from else NONE


def plain_words(s: Signals) -> int:
    """Words of letters only, but for one closing mark."""
    return sum(w.isalpha() or w[:-1].isalpha() and w[-1] in ".,;:?" for w in s.words)


# Symbols, letters and plain words look at spelling; repeats, vocabulary and duplicate
# lines at repetition; length and shouting stand alone. They overlap on purpose.
LABELLERS = (
    ("length", lambda s: BAD if s.n_words < 12 else NONE),
    ("symbols", lambda s: vote(s.n_symbols, 0.02 * s.n_words, 0.1 * s.n_words + 1)),
    ("letters", lambda s: vote(s.word_chars - sum(map(str.isalpha, s.text)),
                               0.08 * s.word_chars, 0.12 * s.word_chars)),
    ("plain_words", lambda s: vote(s.n_words - plain_words(s),
                                   0.1 * s.n_words, 0.3 * s.n_words)),
    ("repeats", lambda s: vote(s.n_repeat_words, 0.1 * s.n_words, 0.5 * s.n_words)),
    ("shouting", lambda s: BAD if s.n_upper > 0.4 * s.word_chars else NONE),
    ("duplicate_lines", lambda s: BAD if 2 * s.n_dup_lines > len(s.lines) else NONE),
    ("vocabulary", lambda s: vote(s.n_words - len(set(s.words)),
                                  0.5 * s.n_words, 0.85 * s.n_words)),
)


def votes(text: str) -> str:
    """The labellers' votes as one digit each; no words leave only the length's."""
    s = Signals(text)
    if not s.n_words:
        return str(BAD) + str(NONE) * (len(LABELLERS) - 1)
    return "".join([str(label(s)) for _, label in LABELLERS])


def fit_votes(counts: dict[str, int], rounds: int = 200) -> tuple[dict[str, float], np.ndarray]:
    """EM over vote patterns: (posterior of good by pattern, rates [class, labeller, vote])."""
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], dtype=float)
    one = np.array([[int(c) for c in p] for p in patterns])
    voted = np.stack([one == v for v in (BAD, GOOD, NONE)], axis=2).astype(float)
    cast = voted[:, :, :2].sum(axis=(1, 2))
    good = (voted[:, :, 1].sum(axis=1) + 1) / (cast + 2)
    for _ in range(rounds):
        weight = np.stack([(1 - good) * n, good * n])
        share = (weight.sum(axis=1) + 1) / (n.sum() + 2)
        rates = np.einsum("cp,plv->clv", weight, voted) + 0.1
        rates /= rates.sum(axis=2, keepdims=True)
        log = np.log(share)[:, None] + np.einsum("plv,clv->cp", voted, np.log(rates))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    return dict(zip(patterns, good.tolist(), strict=True)), rates


KINDS = {ord(c): "U" if c.isupper() else "l" if c.isalpha() else "0" if c.isdigit() else c
         for c in map(chr, range(128))}
REPEATED_KIND = re.compile(r"(.)\1+")


def shape(word: str) -> str:
    """The word's pattern: runs of upper, lower, digit and other characters."""
    kinds = word.translate(KINDS) if word.isascii() else "".join(
        ["U" if c.isupper() else "l" if c.isalpha() else "0" if c.isdigit() else c
         for c in word])
    return REPEATED_KIND.sub(r"\1+", kinds)


def buckets(word: str) -> tuple[int, int]:
    mask = (1 << HASH_BITS) - 1
    return (zlib.crc32(word.encode()) & mask,
            zlib.crc32(b"\0" + shape(word).encode()) & mask)


def features(words: list[str], seen: dict) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers and values: log counts over the document, scaled to length one."""
    found = []
    times = Counter(words)
    if len(seen) > 200_000:
        seen.clear()
    for word in times:
        pair = seen.get(word)
        if pair is None:
            pair = buckets(word)
            if len(word) <= 64 and len(seen) <= 200_000:
                seen[word] = pair
        found += pair
    if not found:
        return np.empty(0, np.int32), np.empty(0)
    at, where = np.unique(np.array(found, np.int32), return_inverse=True)
    total = np.bincount(where, np.repeat(np.fromiter(times.values(), float, len(times)), 2))
    value = np.log1p(total)
    return at, value / math.sqrt(float(value @ value))


def drawn(texts: DataFrame, share: float) -> DataFrame:
    """(text, place): the rows whose 64-bit hash of id and text is in the lowest ``share``."""
    place = F.xxhash64("doc_id", "text", F.lit(17)).alias("place")
    upto = min(int(share * 2 ** 64) - 2 ** 63, 2 ** 63 - 1)
    return texts.select("text", place).filter(F.col("place") <= F.lit(upto).cast("long"))


def featured(sample: DataFrame) -> DataFrame:
    """(posterior, at, value, n): the features of every distinct document, and its rows."""
    def make():
        seen = {}

        def work(batch):
            found = [features(Signals(t).words, seen) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), batch.column("posterior"),
                 pa.array([f[0] for f in found], pa.list_(pa.int32())),
                 pa.array([f[1] for f in found], pa.list_(pa.float64()))],
                ["place", "posterior", "at", "value"])
        return work
    rows = per_batch(sample, "place long, posterior double, at array<int>, value array<double>",
                     make)
    return fixed(rows.groupBy("place").agg(
        F.first(F.struct("posterior", "at", "value")).alias("row"), F.count("*").alias("n"))
        .select("row.*", "n"))


def train(rows: DataFrame) -> tuple[np.ndarray, float] | None:
    """Weights and intercept from ``featured`` rows; None if one class is missing."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors, VectorUDT

    size = 1 << HASH_BITS
    vector = F.udf(lambda at, value: Vectors.sparse(size, at, value), VectorUDT())
    both = rows.select(vector("at", "value").alias("features"), F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("posterior").alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (1 - F.col("posterior")).alias("weight")))).alias("l"),
        "n").filter("l.weight > 0.001").select(
            "features", "l.label", (F.col("l.weight") * F.col("n")).alias("weight")).cache()
    try:
        if both.select("label").distinct().count() < 2:
            return None
        model = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=50).fit(both)
    finally:
        both.unpersist()
    return model.coefficients.toArray(), float(model.intercept)


SCORED = "doc_id long, score double, kept boolean"


def classify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per document: the scorer's score and verdict."""
    spark = docs.sparkSession

    def voting():
        def work(batch):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([votes(t) for t in texts_of(batch)])],
                ["doc_id", "votes"])
        return work
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = {r["votes"]: r["count"] for r in per_batch(
        texts, "doc_id long, votes string", voting).groupBy("votes").count().collect()}
    if not counted:
        return spark.createDataFrame([], SCORED)
    posterior, _ = fit_votes(counted)
    share = min(1.0, sample_rows / sum(counted.values()))
    def labelling():
        def work(batch):
            yield pa.RecordBatch.from_arrays(
                [batch.column("text"), batch.column("place"),
                 pa.array([posterior[votes(t)] for t in texts_of(batch)])],
                ["text", "place", "posterior"])
        return work

    def sample():
        return featured(per_batch(drawn(texts, share),
                                  "text string, place long, posterior double", labelling))
    rows = sample()
    while share < 1 and (n := rows.count()) < sample_rows / 2:
        share = min(1.0, share * min(WIDEN, sample_rows / max(n, 1)))
        rows = sample()
    model = train(rows)
    shared = spark.sparkContext.broadcast(model)

    def scoring():
        seen = {}
        fitted = shared.value

        def score(text: str) -> float:
            if fitted is None:
                return posterior[votes(text)]
            at, value = features(Signals(text).words, seen)
            return 1 / (1 + math.exp(-max(-500, min(500, float(fitted[0][at] @ value)
                                                   + fitted[1]))))

        def work(batch):
            scores = np.array([score(t) for t in texts_of(batch)])
            yield pa.RecordBatch.from_arrays(
                [pc.cast(batch.column("doc_id"), pa.int64()), pa.array(scores),
                 pa.array(scores >= KEEP_FROM)], ["doc_id", "score", "kept"])
        return work
    return per_batch(texts, SCORED, scoring)
