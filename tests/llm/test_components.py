"""Connected components: long chains, few rounds, and no size estimate that grows by rounds."""

import random

import pytest
from pyspark.sql import functions as F

from farpoint.llm import components as op
from farpoint.llm import jaccard_join
from tests.llm.test_jaccard_join import brute, frame


def least_labels(links):
    top = {x: x for link in links for x in link}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        top[b] = a
    return {x: find(x) for x in top}


@pytest.fixture
def rounds(monkeypatch):
    """Spark's guesses of the sizes of the tables that were written."""
    real, seen = op.materialise_at, []

    def seeing(frame, name):
        out = real(frame, name)
        if name == "labels":
            seen.append(int(out[0]._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        return out
    monkeypatch.setattr(op, "materialise_at", seeing)
    return seen


def test_a_long_chain_takes_few_rounds(spark, rounds):
    n = 2000
    links = spark.range(n, numPartitions=4).select(
        F.xxhash64("id").alias("a"), F.xxhash64(F.col("id") + 1).alias("b"))
    found = op.components(links).agg(
        F.count("*"), F.min("node"), F.min("component"), F.max("component")).first()
    assert found[0] == n + 1
    assert found[1] == found[2] == found[3]
    assert 2 < len(rounds) <= 20
    assert max(rounds) < 10**6


def test_the_size_estimate_does_not_grow_by_rounds(spark):
    names = random.Random(5).sample(range(10**9), 30)
    links = list(zip(names, names[1:], strict=False))
    found = op.components(spark.createDataFrame(links, "a long, b long").repartition(2))
    guess = found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert len(str(guess)) < 12
    assert dict(found.collect()) == least_labels(links)


def test_components_of_random_links(spark):
    rnd = random.Random(2)
    for n, m in ((60, 30), (300, 260), (40, 200)):
        links = [(rnd.randrange(-n, n), rnd.randrange(-n, n)) for _ in range(m)]
        hub = [(n + 1, x) for x in range(n, n + 30)] + [(3, 3), (n + 77, n + 77)]
        found = op.components(spark.createDataFrame(links + hub, "a long, b long").repartition(3))
        assert dict(found.collect()) == least_labels(links + hub)
    assert op.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_chain_of_near_copies_is_one_component(spark):
    rnd = random.Random(11)
    words = ["".join(rnd.choices("abcdefgh", k=6)) for _ in range(180)]
    rows = [(1000 - i, " ".join(words[i:i + 60])) for i in range(120)]
    rows += [(2000 + i, " ".join(words[i * 3:i * 3 + 20])) for i in range(5)]
    for leaf in (jaccard_join.LEAF, 16):
        got = jaccard_join.jaccard_components(frame(spark, rows), leaf=leaf).collect()
        assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
