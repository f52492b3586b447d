"""Quality rules as a short-circuit cascade.

A rule rejects a document from a few counts over its whole text. Every task
tries all rules on the first documents of its own partition (the sample),
measures each rule's cost in seconds and its share of rejections, and from
then on runs the rules in descending order of rejections per second; a
document leaves the cascade at its first rejection. The order only decides
what is computed, never the verdict: a document is kept if no rule rejects it.

Null texts have no words. Documents are judged one by one, so ties and
repeated rows each get their own equal verdict; empty tables give no rows.
Extra columns are passed through by ``filter_documents``, whatever they are called.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import SPACES, WORD, per_batch, texts_of

SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 200


class Signals:
    """Counts over one text, each computed when a rule first asks for it."""

    def __init__(self, text: str):
        self.text = text

    @cached_property
    def words(self) -> list[str]:
        return WORD.findall(self.text)

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return sum(map(len, self.words))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        w = self.words
        windows = list(zip(w, w[1:], w[2:], strict=False))
        if len(set(windows)) == len(windows):
            return 0
        times = Counter(windows)
        covered, upto = 0, 0
        for i, window in enumerate(windows):
            if times[window] > 1:
                covered += i + 3 - max(upto, i)
                upto = i + 3
        return covered

    @cached_property
    def n_upper(self) -> int:
        return sum(c.isupper() for c in self.text) if not self.text.isascii() else \
            sum(map(self.text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Signals], bool]


# The first two are the contract's base rules; the rest follow published web-text filters.
FEW_WORDS = Rule("few_words", lambda s: s.n_words < 50)
REPEATED = Rule("repeated_windows", lambda s: 100 * s.n_repeat_words > 50 * s.n_words)
RULES = (
    FEW_WORDS,
    REPEATED,
    Rule("symbols", lambda s: 10 * s.n_symbols > s.n_words),
    Rule("duplicate_lines", lambda s: 2 * s.n_dup_lines > len(s.lines)),
    Rule("word_length", lambda s: not 2 * s.n_words <= s.word_chars <= 15 * s.n_words),
    Rule("shouting", lambda s: 10 * s.n_upper > 4 * s.word_chars),
)


def cascade_order(rules: tuple[Rule, ...], texts: list[str]) -> list[Rule]:
    """``rules`` by rejections per second on ``texts``, each timed from scratch."""
    rated = []
    for place, rule in enumerate(rules):
        began = time.perf_counter()
        rejected = sum(rule.rejects(Signals(t)) for t in texts)
        spent = max(time.perf_counter() - began, 1e-9)
        rated.append((-rejected / spent, spent, place))
    return [rules[place] for *_, place in sorted(rated)]


class Cascade:
    """Orders the rules on the first ``sample_rows`` texts it sees, then judges."""

    def __init__(self, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS):
        self.rules, self.sample_rows, self.order = rules, sample_rows, None

    def prepare(self, texts: list[str]) -> None:
        if self.order is None:
            self.order = cascade_order(self.rules, texts[:self.sample_rows])

    def keeps(self, signals: Signals) -> bool:
        return not any(rule.rejects(signals) for rule in self.order)


def filter_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES,
                     sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, with all their columns."""
    place = docs.columns.index("text")

    def make():
        cascade = Cascade(rules, sample_rows)

        def work(batch):
            texts = [t or "" for t in batch.column(place).to_pylist()]
            cascade.prepare(texts)
            yield batch.filter(pa.array([cascade.keeps(Signals(t)) for t in texts]))
        return work
    return per_batch(docs, docs.schema, make)


REPORT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean")


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES,
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: base counts, ``base_failed`` and the verdict ``kept``."""
    def make():
        cascade = Cascade(rules, sample_rows)

        def work(batch):
            texts = texts_of(batch)
            cascade.prepare(texts)
            rows = []
            for text in texts:
                s = Signals(text)
                kept = cascade.keeps(s)
                failed = FEW_WORDS.rejects(s) or REPEATED.rejects(s)
                rows.append((s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines,
                             s.n_repeat_words, failed, kept and not failed))
            columns = [pa.array(c) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pc.cast(batch.column("doc_id"), pa.int64()), *columns],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                 "n_repeat_words", "base_failed", "kept"])
        return work
    return per_batch(docs.select("doc_id", "text"), REPORT, make)
