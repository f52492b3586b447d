"""Bisecting fits of all k in shared passes, against MLlib's own fits."""

import random

import pytest
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.linalg import Vectors

from farpoint.operators import clustering
from farpoint.operators.bisecting import fit_bisecting


@pytest.fixture(scope="module")
def points(spark):
    rnd = random.Random(4)
    rows = [(Vectors.dense(rnd.gauss(i ** 0.5, 1), rnd.gauss(5 * (i % 4), 1)),)
            for i in range(600)]
    return spark.createDataFrame(rows, ["features"]).repartition(9).checkpoint()


def test_models_of_all_k_are_mllibs(points):
    ks = [3, 4, 6, 8, 10]
    own = fit_bisecting(points, ks, 1)
    assert sorted(own) == ks
    for k in ks:
        model = BisectingKMeans(k=k, seed=1).fit(points)
        centres = own[k].clusterCenters()
        assert len(centres) == len(model.clusterCenters()) == k
        for a, b in zip(centres, model.clusterCenters(), strict=True):
            assert a == pytest.approx(list(b), rel=1e-9)
        placed = own[k].setPredictionCol("own").transform(model.transform(points))
        assert placed.where("own <> prediction or own is null").count() == 0


def test_search_makes_no_fit_for_each_k(points, monkeypatch):
    def fit(*_):
        raise AssertionError("a fit of one k")
    monkeypatch.setattr(clustering, "fit", fit)
    found = clustering.search_k(points, "bisectingKMeans", 3, 5)
    assert sorted(found.scores) == [3, 4, 5] and len(found.model.clusterCenters()) == found.k


def test_fewer_points_than_clusters(spark):
    same = spark.createDataFrame([(Vectors.dense(float(i % 2)),) for i in range(8)], ["features"])
    for model in fit_bisecting(same, [3, 5], 1).values():
        assert sorted(c[0] for c in model.clusterCenters()) == [0.0, 1.0]


def test_infinite_coordinate_is_an_error(spark):
    rows = [(Vectors.dense(v),) for v in (1.0, 2.0, float("inf"))]
    with pytest.raises(ValueError, match="NaN or infinite"):
        fit_bisecting(spark.createDataFrame(rows, ["features"]), [3], 1)
