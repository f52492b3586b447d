"""Silhouettes of all k in two scans, against MLlib's evaluator for each k."""

import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from conftest import MALL_FEATURES, SF_SMALL
from farpoint.operators import clustering
from farpoint.operators.features import fit_features

KS = {k: f"cluster_{k}" for k in range(3, 11)}


def by_evaluator(rows, column):
    return ClusteringEvaluator(featuresCol="features", predictionCol=column,
                               distanceMeasure="squaredEuclidean").evaluate(
        rows.withColumn(column, F.col(column).cast("double")))


def assigned(spark, rows, prep, algorithm):
    vectors = prep.vectors(rows).cache()
    out = vectors
    for k, column in KS.items():
        model = clustering.fit(vectors, algorithm, k)
        out = model.copy({model.predictionCol: column}).transform(out)
    return out


@pytest.mark.parametrize("algorithm", ["kMeans", "bisectingKMeans"])
@pytest.mark.parametrize("name", ["mall", "events"])
def test_scores_equal_the_evaluators(spark, mall, algorithm, name):
    rows, features = (mall[0], MALL_FEATURES) if name == "mall" else (
        spark.read.parquet(f"{SF_SMALL}/events.parquet"), ["event_type", "value", "user_id"])
    prep = fit_features(rows, features)
    found = assigned(spark, rows, prep, algorithm)
    scores = clustering.silhouettes(found, KS, prep.dimension)
    for k, column in KS.items():
        assert scores[k] == pytest.approx(by_evaluator(found, column), abs=1e-12)


def test_lone_rows_empty_clusters_and_ties(spark):
    points = [(0, 0.0, 1.0), (0, 0.0, 1.0), (1, 5.0, 5.0), (4, -3.0, 2.0), (4, -3.0, 2.0),
              (4, 2.5, 3.0)]
    rows = spark.createDataFrame([(c, c % 2, [x, y]) for c, x, y in points],
                                 "c int, d int, x array<double>").select(
        "c", "d", array_to_vector("x").alias("features"))
    scores = clustering.silhouettes(rows, {3: "c", 2: "d"}, 2)
    for k, column in {3: "c", 2: "d"}.items():
        assert scores[k] == pytest.approx(by_evaluator(rows, column), abs=1e-12)
    with pytest.raises(ValueError, match="one cluster"):
        clustering.silhouettes(rows.withColumn("e", F.lit(1)), {2: "d", 3: "e"}, 2)


def test_search_scores_all_models_in_two_scans(spark, mall, monkeypatch):
    """One aggregate over one scan gives the sums of all clusters of all k."""
    prep = fit_features(mall[0], MALL_FEATURES)
    vectors = prep.vectors(mall[0])
    monkeypatch.setattr(clustering, "silhouette", None)      # no scoring one k at a time
    found = clustering.search_k(vectors, "kMeans")
    assert set(found.scores) == set(KS) and found.k == 4
    rows = vectors.repartition(4).select(F.col("features").alias("v"), F.lit(1).alias("a"), F.lit(2).alias("b"))
    from pyspark.ml.functions import vector_to_array
    sums = clustering.cluster_sums(
        rows.select(vector_to_array("v").alias("x"), F.lit(0.0).alias("n2"), "a", "b"),
        {3: "a", 4: "b"}, prep.dimension)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan
