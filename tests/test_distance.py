"""Distance columns: parity with MLlib's sqdist, metric names, batched path."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from farpoint.functions import distance as D


def test_squared_euclidean_is_sqdist(spark):
    pts = [(1.0, 2.0, 3.5), (0.1, -7.0, 2.0)]
    centre = [0.3, 1.7, -2.2]
    df = spark.createDataFrame(pts, "a double, b double, c double")
    xs = [F.col("a"), F.col("b"), F.col("c")]
    got = [r[0] for r in df.select(D.squared_euclidean(xs, centre)).collect()]
    want = [Vectors.squared_distance(Vectors.dense(p), Vectors.dense(centre)) for p in pts]
    assert got == want


def test_manhattan(spark):
    df = spark.createDataFrame([(1.0, -2.0)], "a double, b double")
    got = df.select(D.manhattan([F.col("a"), F.col("b")], [4.0, 1.0])).first()[0]
    assert got == 6.0


def test_metric_names_case_insensitive():
    assert D.metric_by_name("Euclidean") == "euclidean"
    assert D.metric_by_name("MANHATTAN") == "manhattan"
    with pytest.raises(ValueError):
        D.metric_by_name("cosine")


def test_nearest_inline_vs_batched(spark):
    import random
    rnd = random.Random(7)
    centres = [[rnd.uniform(-5, 5), rnd.uniform(-5, 5)] for _ in range(70)]
    df = spark.createDataFrame([(rnd.uniform(-6, 6), rnd.uniform(-6, 6)) for _ in range(50)],
                               "a double, b double")
    xs = [F.col("a"), F.col("b")]
    batched = [r[0] for r in df.select(D.nearest_distance(xs, centres, "euclidean")).collect()]
    inline = [r[0] for r in df.select(F.least(*[D.squared_euclidean(xs, c) for c in centres])).collect()]
    assert batched == pytest.approx(inline, rel=1e-12)
    man_b = [r[0] for r in df.select(D.nearest_distance(xs, centres, "manhattan")).collect()]
    man_i = [r[0] for r in df.select(F.least(*[D.manhattan(xs, c) for c in centres])).collect()]
    assert man_b == pytest.approx(man_i, rel=1e-12)


def test_nearest_centre_index(spark):
    df = spark.createDataFrame([(0.0,), (9.0,), (5.1,)], "a double")
    got = [r[0] for r in df.select(D.nearest_centre([F.col("a")], [[0.0], [10.0], [5.0]])).collect()]
    assert got == [0, 1, 2]
