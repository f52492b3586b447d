"""Phrase collocations by SETM: relational mining over sorted occurrence relations.

Lower-cased (A-Z) texts are split at ``.,;:!?`` and line ends into pieces, and pieces
at blanks and tabs into words. Relation R1 holds one occurrence for every word: its
position and its item. Positions skip one number at every piece's end, so adjacent
positions always lie in one piece. Level k then repeats SETM's steps:

1. group-count: items are counted in every run and summed per language over all runs;
2. semi-join: every run keeps its groups met ``min_count`` times or more in all; other
   occurrences leave;
3. merge-join: what stays is still sorted, so an occurrence of k words meets the one
   at the next position, and both make up an occurrence of k + 1 words.

A relation lies in runs of about ``RUN_WORDS`` words, written sorted to the shared
folder: steps between positions, and items. Occurrences are never shuffled by what they
say: a run's distinct groups are, with their counts, so a word that makes up a third of
the corpus is one short row for each run. One shuffle sums a group up and tells every run
that holds it. A level's relation is deleted when the next one is written.

Counts are exact: scores are whole-number divisions of 38-digit decimals, and
1,000,000 * a * a fits them for any a up to 10^16. Null texts are empty and have no
words; a null language is ``und``, together with a real ``und``. Copies and repeated
rows count as often as they stand. Ties end at the phrase's bytes, so ranks are unique.
Columns besides text and lang are not read. Empty tables give no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import drop_path, materialise_at

WORDS, MIN_COUNT, COVER, TOP = 3, 10, 50, 2000
RUN_WORDS, PIECE_BYTES = 1 << 20, 1 << 20
NO_LANG = "und"
# 0xFF stands in no UTF-8 text: it marks the end of a piece.
_END = b"\xff"
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r",
                        b"abcdefghijklmnopqrstuvwxyz" + 10 * _END)
SALTS = 64
# A group's id is its first place: run (task and number in the task) and code in the run.
TASK_RUNS, CODES = 1 << 12, 1 << 27

RELATION = "run long, n int, steps binary, items binary"
RUNS = (RELATION + ", langs array<string>, words array<string>, lang array<int>, "
        "counts array<long>")
GROUPS = RELATION + ", lefts array<long>, rights array<long>, counts array<long>"


class _Codes(dict):
    """Numbers for keys in the order they are first met."""

    def __missing__(self, key):
        self[key] = found = len(self)
        return found


class _Run:
    """The occurrences of one run while its documents are read."""

    def __init__(self):
        self.words = {}         # language -> codes of its words, end mark first
        self.base = []          # (language, first position, codes)
        self.next = 0
        self.size = 0

    def add(self, lang: str, texts: list[bytes]) -> None:
        codes = self.words.setdefault(lang, _Codes({_END: 0}))
        joined = _END.join(texts).translate(_FOLD).replace(_END, b" " + _END + b" ")
        found = np.array([codes[w] for w in joined.split()], dtype=np.int32)
        self.base.append((lang, self.next, found))
        self.next += len(found) + 1
        self.size += len(found)

    def row(self, run: int) -> pa.RecordBatch | None:
        names = sorted(self.words)
        first = dict(zip(names, np.cumsum([0, *[len(self.words[n]) - 1 for n in names]]),
                         strict=False))
        starts, items = [], []
        for lang, start, found in self.base:
            worded = np.flatnonzero(found)
            starts.append((worded + start).astype(np.int32))
            items.append(found[worded] - 1 + first[lang].astype(np.int32))
        items = np.concatenate(items).astype(np.int32)
        if not len(items):
            return None
        words = [w for n in names for w in list(self.words[n])[1:]]
        lang = np.repeat(np.arange(len(names), dtype=np.int32),
                         [len(self.words[n]) - 1 for n in names])
        return _record(run, np.concatenate(starts), items,
                       langs=pa.array([names], pa.list_(pa.string())),
                       words=_one_list(pa.array(words, pa.binary()).cast(pa.string())),
                       lang=_one_list(pa.array(lang)),
                       counts=_one_list(pa.array(np.bincount(items, minlength=len(words)))))


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _record(run: int, starts: np.ndarray, items: np.ndarray, **lists: pa.Array
            ) -> pa.RecordBatch:
    """A run's row: its sorted relation, compressed, and lists about its groups."""
    packed = [pa.array([pa.compress(np.ascontiguousarray(c, "<i4"), "zstd", asbytes=True)],
                       pa.binary()) for c in (np.diff(starts, prepend=0), items)]
    return pa.RecordBatch.from_arrays(
        [pa.array([run], pa.int64()), pa.array([len(items)], pa.int32()), *packed,
         *lists.values()], ["run", "n", "steps", "items", *lists])


def _relation(row: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Positions and items of a run's row."""
    size = 4 * row.column("n")[0].as_py()
    steps, items = (np.frombuffer(pa.decompress(row.column(name)[0].as_buffer(), size, "zstd"),
                                  dtype="<i4") for name in ("steps", "items"))
    return np.cumsum(steps), items


def occurrences(docs: DataFrame) -> DataFrame:
    """R1 in runs: sorted positions and items, and the run's words with their counts."""
    def work(batches):
        context = TaskContext.get()
        number, run = (context.partitionId() if context else 0) * TASK_RUNS, _Run()
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            held, size = {}, 0
            for i, (lang, text) in enumerate(zip(langs, texts, strict=True)):
                if text:
                    held.setdefault(lang, []).append(text)
                    size += len(text)
                if size >= PIECE_BYTES or i + 1 == len(texts):
                    for name, found in held.items():
                        run.add(name, found)
                    held, size = {}, 0
                    if run.size >= RUN_WORDS:
                        if (row := run.row(number)) is not None:
                            yield row
                        number, run = number + 1, _Run()
        if run.size and (row := run.row(number)) is not None:
            yield row
    read = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text")
    return read.mapInArrow(work, RUNS)


def adjacent(starts: np.ndarray, items: np.ndarray, keep: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Semi-join and merge-join of one sorted run.

    ``keep`` holds each item's group id, -1 for infrequent ones. Returns the position
    and both group ids wherever two kept occurrences stand at adjacent positions.
    """
    groups = keep[items]
    kept = np.flatnonzero(groups >= 0)
    starts, groups = starts[kept], groups[kept]
    meets = np.flatnonzero(starts[1:] == starts[:-1] + 1)
    return starts[meets], groups[meets], groups[meets + 1]


def _extend(relation: pa.Table, frequent: pa.Table) -> pa.Table:
    """One run's relation of the next level, with its distinct groups and counts."""
    out = pa.schema([("run", pa.int64()), ("n", pa.int32()), ("steps", pa.binary()),
                     ("items", pa.binary()),
                     *[(n, pa.list_(pa.int64())) for n in ("lefts", "rights", "counts")]])
    if not relation.num_rows or not frequent.num_rows:
        return out.empty_table()
    starts, items = _relation(relation)
    code, found = frequent.column("code").to_numpy(), frequent.column("id").to_numpy()
    keep = np.full(int(items.max()) + 1, -1, dtype=np.int64)
    keep[code] = np.arange(len(code))
    at, left, right = adjacent(starts, items, keep)
    if not len(at):
        return out.empty_table()
    pairs, again, counts = np.unique(left * len(code) + right, return_inverse=True,
                                     return_counts=True)
    row = _record(relation.column("run")[0].as_py(), at, again,
                  lefts=_one_list(pa.array(found[pairs // len(code)])),
                  rights=_one_list(pa.array(found[pairs % len(code)])),
                  counts=_one_list(pa.array(counts.astype(np.int64))))
    return pa.Table.from_batches([row]).cast(out)


def frequent_groups(local: DataFrame, keys: list[str], min_count: int) -> DataFrame:
    """Every run's frequent groups: run, code, keys, f over all runs, and the group's id.

    ``local`` has one row for each run and distinct group, so a window over a group holds
    at most one short row for each run.
    """
    same = Window.partitionBy(*keys)
    place = F.col("run") * F.lit(CODES) + F.col("code")
    return (local.select("run", "code", *keys, F.sum("n").over(same).alias("f"),
                         F.min(place).over(same).alias("id"))
            .filter(F.col("f") >= min_count))


def mine(docs: DataFrame, words: int = WORDS, min_count: int = MIN_COUNT
         ) -> tuple[list[DataFrame], DataFrame, list[str]]:
    """Frequent phrases of 1 to ``words`` words, the words of every language, scratch paths.

    A level's table holds id, lang, phrase (array of words), f, and its parts' counts:
    heads[i] and tails[i] are the counts of the first and of the last i + 1 words. From
    two words on, left and right are the ids of all but the last and all but the first.
    """
    paths = []

    def kept(frame: DataFrame, name: str) -> DataFrame:
        found, path = materialise_at(frame, f"setm-{name}")
        paths.append(path)
        return found

    relation, at = materialise_at(occurrences(docs), "setm-relation")
    local = relation.select("run", F.posexplode(F.arrays_zip("words", "lang", "counts"))
                            .alias("code", "g"), "langs").select(
        "run", "code", F.element_at("langs", F.col("g.lang") + 1).alias("lang"),
        F.col("g.words").alias("word"), F.col("g.counts").alias("n"))
    sizes = kept(local.groupBy("lang").agg(F.sum("n").alias("n")), "sizes")
    keys, levels = ["lang", "word"], []
    for size in range(1, words + 1):
        if size < words:
            groups, held = materialise_at(frequent_groups(local, keys, min_count), "setm-groups")
            first = F.col("id") == F.col("run") * F.lit(CODES) + F.col("code")
            counted = groups.filter(first).select("id", *keys, "f")
        else:
            counted = local.groupBy(*keys).agg(F.sum("n").alias("f")).filter(
                F.col("f") >= min_count).select(F.lit(None).cast("long").alias("id"), *keys, "f")
        levels.append(kept(_described(counted, levels[-1]) if size > 1 else counted.select(
            "id", "lang", F.array("word").alias("phrase"), "f", F.array("f").alias("heads"),
            F.array("f").alias("tails")), f"level-{size}"))
        if size == words:
            break
        known = groups.select(F.col("run").alias("of_run"), "code", "id")
        following, after = materialise_at(
            relation.select("run", "n", "steps", "items").groupBy("run")
            .cogroup(known.groupBy("of_run")).applyInArrow(_extend, GROUPS), "setm-relation")
        drop_path(docs.sparkSession, at)
        drop_path(docs.sparkSession, held)
        relation, at = following, after
        local = relation.select("run", F.posexplode(F.arrays_zip("lefts", "rights", "counts"))
                                .alias("code", "g")).select(
            "run", "code", F.col("g.lefts").alias("left"), F.col("g.rights").alias("right"),
            F.col("g.counts").alias("n"))
        keys = ["left", "right"]
    drop_path(docs.sparkSession, at)
    return levels, sizes, paths


def _described(frequent: DataFrame, below: DataFrame) -> DataFrame:
    """Words and part counts of groups of two neighbouring phrases of the level below."""
    left = below.select(F.col("id").alias("left"), "lang", "phrase", "heads")
    right = below.select(F.col("id").alias("right"),
                         F.element_at("phrase", -1).alias("last"), "tails")
    return frequent.join(left, "left").join(right, "right").select(
        "id", "lang", F.concat("phrase", F.array("last")).alias("phrase"), "f",
        F.concat("heads", F.array("f")).alias("heads"),
        F.concat("tails", F.array("f")).alias("tails"), "left", "right")


def weakest_cut(size: int) -> Column:
    """(score, k, l, r) of the cut with the lowest score; the first of equals."""
    wide = lambda c: c.cast("decimal(38,0)")
    cuts = []
    for k in range(1, size):
        head, tail = F.col("heads")[k - 1], F.col("tails")[size - k - 1]
        above = F.lit(1000000).cast("decimal(38,0)") * (wide(F.col("f")) * wide(F.col("f")))
        score = F.call_function("div", above, wide(head) * wide(tail))
        cuts.append(F.struct(score.cast("long").alias("score"), F.lit(k).alias("k"),
                             head.alias("l"), tail.alias("r")))
    return cuts[0] if len(cuts) == 1 else F.least(*cuts)


def best(scored: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of every language, ranked from 1.

    Two rounds over hashed shares of a language leave the last one at most ``SALTS``
    times ``top`` rows, however large the language is.
    """
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS * SALTS))
    for share in ([salt], [F.pmod(salt, F.lit(SALTS))], []):
        window = Window.partitionBy("lang", *share).orderBy(*order)
        scored = scored.withColumn("rank", F.row_number().over(window)).filter(
            F.col("rank") <= top)
    return scored


def collocations(docs: DataFrame, words: int = WORDS, min_count: int = MIN_COUNT,
                 cover: int = COVER, top: int = TOP) -> DataFrame:
    """Best phrases of every language: lang, rank, phrase, a, l, r, n, score.

    ``cover``: a phrase leaves where a longer candidate around it has at least that
    many hundredths of its count. A phrase never occurs less often than a longer one
    around it, so looking at candidates of one word more is enough.
    """
    levels, sizes, paths = mine(docs, words, min_count)
    kept = []
    for size, level in enumerate(levels[1:], 2):
        if size < words:
            longer = levels[size]
            around = (longer.select(F.col("left").alias("id"), "f")
                      .union(longer.select("right", "f"))
                      .groupBy("id").agg(F.max("f").alias("around")))
            level = level.join(around, "id", "left").filter(
                F.coalesce(F.lit(100) * F.col("around") < F.lit(cover) * F.col("f"), F.lit(True)))
        cut = weakest_cut(size).alias("cut")
        kept.append(level.select("lang", F.concat_ws(" ", "phrase").alias("phrase"),
                                 F.col("f").alias("a"), cut)
                    .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    ranked = best(reduce(DataFrame.union, kept), top).join(sizes, "lang")
    found, _ = materialise_at(ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"),
        "collocations")
    for path in paths:
        drop_path(docs.sparkSession, path)
    return found
