"""The Jaccard join against all pairs, with regions small and large, nulls, ties, repeats."""

import random
import re

import numpy as np
import pytest

from farpoint.llm import jaccard_join as op

SCHEMA = "doc_id long, text string, node string, region int, n int"
WORD = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def grams(text, width=3):
    words = WORD.findall(lower(text))
    if len(words) < width:
        return {" ".join(words)} if words else set()
    return {" ".join(words[i:i + width]) for i in range(len(words) - width + 1)}


def brute(rows, percent=90, width=3):
    sets = [grams(t, width) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= \
                    percent * len(sets[i] | sets[j]):
                top[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(find(i), []).append(2**63 if d is None else d)
    out = []
    for i, (d, _) in enumerate(rows):
        low = min(least[find(i)])
        out.append((d, len(sets[i]), None if low == 2**63 else low))
    return sorted(out, key=repr)


def near_copies(rnd, words, n, edits):
    out = []
    for _ in range(n):
        copy = list(words)
        for _ in range(rnd.randint(0, edits)):
            copy[rnd.randrange(len(copy))] = rnd.choice("xyzuvw") + str(rnd.randint(0, 999))
        out.append(" ".join(copy))
    return out


def some_rows(seed=1):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdeé", k=rnd.randint(1, 6)))
    texts = []
    for size in (3, 5, 11, 12, 20, 21, 60, 200, 1000):
        words = [word() for _ in range(size)]
        texts += near_copies(rnd, words, 12, max(1, size // 25))
        texts += [" ".join(words + words[:k]) for k in (1, 2, size // 9)]
    base = [word() for _ in range(120)]
    texts += near_copies(rnd, base, 150, 4)          # a crowd whose links are borderline
    shared = " ".join(word() for _ in range(80))
    texts += [shared + " " + " ".join(word() for _ in range(rnd.randint(5, 60)))
              for _ in range(40)]
    texts += ["", None, " \n", "one", "ONE", "two words", "Two\twords", "a b c", "a b c a b c",
              "é\x1cx y", texts[0].upper(), texts[5], texts[5], " ".join(base * 60)]
    rows = [(i * 2, t) for i, t in enumerate(texts)]
    return rows + [(None, texts[0]), (None, "all alone here"), (None, None), (8, texts[80]),
                   (8, texts[80])]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def rows():
    return some_rows()


@pytest.mark.parametrize("leaf", [op.LEAF, 16])
def test_components_equal_all_pairs(spark, rows, leaf):
    rows = rows if leaf == op.LEAF else rows[60:230] + rows[-30:]      # more rounds: fewer rows
    found = op.jaccard_components(frame(spark, rows), leaf=leaf)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    want = brute(rows)
    assert got == want
    assert len({w[2] for w in want}) < len(rows) - 50


def test_other_thresholds(spark, rows):
    some = rows[40:120] + rows[-20:]
    for percent, width in ((80, 5), (60, 2)):
        got = op.jaccard_components(frame(spark, some), width, percent, leaf=16).collect()
        assert sorted((tuple(r) for r in got), key=repr) == brute(some, percent, width)


def test_linked_sets_share_a_region():
    rnd = np.random.default_rng(3)
    for percent in (90, 80):
        rings = op.Rings(percent)
        for _ in range(600):
            size = int(rnd.integers(1, 300))
            x = np.unique(rnd.integers(0, 2**63, size).astype(np.uint64))
            gone = rnd.integers(0, max(1, size * (100 - percent) // 100) + 1)
            more = rnd.integers(0, max(1, size * (100 - percent) // 100) + 1)
            y = np.unique(np.r_[rnd.permutation(x)[gone:],
                                rnd.integers(0, 2**63, more).astype(np.uint64)])
            common = len(np.intersect1d(x, y))
            if len(y) and 100 * common >= percent * (len(x) + len(y) - common):
                assert np.intersect1d(rings.signatures(x), rings.signatures(y)).size


def test_joining_links_of_one_region():
    rnd = random.Random(7)
    for _ in range(40):
        base = rnd.sample(range(10**6), 60)
        sets = [sorted(set(rnd.sample(base, rnd.randint(50, 60)) + rnd.sample(range(10**6), 2)))
                for _ in range(rnd.randint(2, 25))]
        grams = [np.array(s, dtype=np.int64) for s in sets]
        labels = np.array([rnd.randint(0, 9) for _ in sets])
        some = np.flatnonzero(labels > 4)
        common = op.common_shingles(some, grams)
        assert all(common[x, y] == len(set(sets[i]) & set(sets[y]))
                   for x, i in enumerate(some) for y in range(len(sets)) if y != i)
        links = op.joining_links(np.arange(len(sets)), labels, grams, 85)
        assert all(100 * len(set(sets[a]) & set(sets[b])) >= 85 * len(set(sets[a]) | set(sets[b]))
                   for a, b in links)

        def parts(pairs):
            top = {i: i for i in range(10)}
            for a, b in pairs:
                low, high = sorted((top[labels[a]], top[labels[b]]))
                top = {k: low if v == high else v for k, v in top.items()}
            return top
        every = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(
            set(sets[a]) & set(sets[b])) >= 85 * len(set(sets[a]) | set(sets[b]))]
        assert parts(links) == parts(every)
        assert len(links) == 10 - len(set(parts(every).values()))


def test_equal_hashes_of_unequal_sets_are_hashed_anew(spark, rows, monkeypatch):
    some, seeds = frame(spark, rows[:60]), []
    real = op.marked_sets

    def clashing(docs, shingle, percent, seed):
        seeds.append(seed)
        found = real(docs, shingle, percent, seed)
        return found.withColumn("node", op.F.lit(1).cast("long")) if seed == 0 else found
    monkeypatch.setattr(op, "marked_sets", clashing)
    got = op.jaccard_components(some).collect()
    assert seeds == [0, 1]
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows[:60])


def test_empty_table(spark):
    assert op.jaccard_components(frame(spark, [])).collect() == []
    blank = op.jaccard_components(frame(spark, [(3, None), (2, " "), (None, "")])).collect()
    assert sorted(map(tuple, blank), key=repr) == [(2, 0, 2), (3, 0, 3), (None, 0, None)]
