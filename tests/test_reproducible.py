"""Training gives one model: repeated, cached or not, and against MLlib itself."""

import pytest
from pyspark.ml.clustering import KMeans

from farpoint.operators.features import fit_features
from farpoint.plans.model import train

from conftest import SF_SMALL

FEATURES = ["event_type", "value", "user_id"]


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """events in 12 files, read in many small splits."""
    path = str(tmp_path_factory.mktemp("events") / "many")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(12).write.parquet(path)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes",
                                          "spark.sql.files.openCostInBytes")}
    for key in old:
        spark.conf.set(key, "4096")
    yield spark.read.parquet(path)
    for key, value in old.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("algorithm", ["kMeans", "bisectingKMeans"])
def test_repeated_and_uncached_training_agree(events, algorithm):
    assert events.rdd.getNumPartitions() >= 12
    models = [train(events, FEATURES, algorithm, k=5, cache=c).centres
              for c in (True, True, True, True, False)]
    assert all(m == models[0] for m in models)


def test_equal_to_mllib_on_the_same_coordinates(events):
    vectors = fit_features(events, FEATURES).vectors(events)
    direct = KMeans(k=5, seed=1, featuresCol="features").fit(vectors).clusterCenters()
    assert train(events, FEATURES, "kMeans", k=5).centres == [list(c) for c in direct]


def test_partitions_make_the_model_independent_of_the_split(spark, events):
    one = events.coalesce(1)
    many = train(events, FEATURES, "kMeans", k=5, partitions=4).centres
    for a, b in zip(many, train(one, FEATURES, "kMeans", k=5, partitions=4).centres, strict=True):
        assert a == pytest.approx(b, rel=1e-9)
