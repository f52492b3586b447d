"""SETM collocations against a brute-force count, with nulls, ties and repeats."""

import random
import re
from collections import Counter

import pytest

from farpoint.llm import collocations as op

SCHEMA = "doc_id long, text string, lang string, run string, f int, phrase string, id int"
ENDS = re.compile("[.,;:!?\x0a-\x0d]")
WORD = re.compile("[^\x20\x09]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, words, min_count, cover, top):
    grams, sizes = Counter(), Counter()
    for text, lang in rows:
        for piece in ENDS.split(lower(text)):
            found = WORD.findall(piece)
            sizes[lang or "und"] += len(found)
            for k in range(1, words + 1):
                for i in range(len(found) - k + 1):
                    grams[lang or "und", tuple(found[i:i + k])] += 1
    often = {g: n for g, n in grams.items() if n >= min_count}
    out = {}
    for (lang, p), a in often.items():
        if len(p) < 2:
            continue
        if any(n * 100 >= cover * a and len(q) > len(p) and other == lang
               and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
               for (other, q), n in often.items()):
            continue
        cuts = [(1000000 * a * a // (grams[lang, p[:k]] * grams[lang, p[k:]]), k)
                for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append(
            (-score, -a, " ".join(p).encode(), a, grams[lang, p[:k]], grams[lang, p[k:]]))
    return {(lang, rank, p.decode(), a, left, right, sizes[lang], -score)
            for lang, found in out.items()
            for rank, (score, _, p, a, left, right) in enumerate(sorted(found)[:top], 1)}


def some_rows(seed=3, n=150):
    rnd = random.Random(seed)
    names = ["été", "ab", "AB", "c\x1cd", "of", "the", "x", "\x00", "Ünï"] + list("defgh")
    rows = []
    for _ in range(n):
        text = "".join(rnd.choice(names) + rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".\n",
                                                       "\x0b", " \r\n "])
                       for _ in range(rnd.randint(0, 40)))
        rows.append((text, rnd.choice(["en", "fr", None, "und"])))
    rows += [(None, "en"), ("", "fr"), (" \t ", None), ("...,,", "en"), ("the ab " * 30000, "en")]
    return rows + rows[:9]


def frame(spark, rows):
    return spark.createDataFrame([(i // 2, t, lang, "r", 1, "p", 2)
                                  for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)


@pytest.mark.parametrize("words,min_count,cover,top,run", [
    (3, 10, 50, 2000, 1 << 20), (3, 3, 50, 40, 300), (2, 2, 50, 2000, 1), (4, 4, 30, 2000, 1000)])
def test_collocations_equal_brute_force(spark, monkeypatch, words, min_count, cover, top, run):
    rows = some_rows()
    monkeypatch.setattr(op, "RUN_WORDS", run)
    monkeypatch.setattr(op, "PIECE_BYTES", 500)
    found = op.collocations(frame(spark, rows), words, min_count, cover, top)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = {tuple(r) for r in found.collect()}
    want = brute(rows, words, min_count, cover, top)
    assert len(want) > 10 and got == want


def test_levels_hold_every_frequent_phrase(spark):
    rows = some_rows(8, 60)
    levels, sizes, _ = op.mine(frame(spark, rows), 3, 5)
    for k, level in enumerate(levels, 1):
        got = {(r["lang"], tuple(r["phrase"])): r["f"] for r in level.collect()}
        want = Counter()
        for text, lang in rows:
            for piece in ENDS.split(lower(text)):
                found = WORD.findall(piece)
                want.update((lang or "und", tuple(found[i:i + k]))
                            for i in range(len(found) - k + 1))
        assert got == {g: n for g, n in want.items() if n >= 5}


def test_scores_beyond_64_bits(spark):
    big = 3 * 10**12
    row = spark.createDataFrame([(big, [big + 7], [big + 1])],
                                "f long, heads array<long>, tails array<long>")
    cut = row.select(op.weakest_cut(2).alias("c")).first()["c"]
    assert cut["score"] == 1000000 * big * big // ((big + 7) * (big + 1))


def test_empty_tables_and_texts_without_words(spark):
    assert op.collocations(frame(spark, [])).collect() == []
    assert op.collocations(frame(spark, [(None, None), ("", "en"), (" .\n", "en")])).collect() == []
    assert op.collocations(frame(spark, [("a b c d", "en")])).collect() == []
