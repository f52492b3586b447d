"""The large-label join without broadcasting, one label holding 40 % of the rows."""

import pytest
from pyspark.sql import functions as F

from farpoint.operators.features import fit_features

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_label_is_split_in_a_sort_merge_join(no_broadcast):
    spark = no_broadcast
    rows = spark.range(0, 200_000, 1, 8).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("pad"),
        F.when(F.col("id") % 5 < 2, "hot").otherwise(
            F.concat(F.lit("label-"), F.col("id") % 3000)).alias("label"))
    prep = fit_features(rows, ["label"], max_local_labels=0)
    assert not prep.labels[0].local and prep.labels[0].mapping is None
    joined = prep.index(rows)
    got = joined.select("id", "label", "label_index", "pad")
    pairs = got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan and "BroadcastHashJoin" not in plan
    assert len(pairs) == 200_000
    assert {r["label_index"] for r in pairs if r["label"] == "hot"} == {0.0}
    counts = rows.groupBy("label").count().collect()
    order = sorted(counts, key=lambda r: (-r["count"], r["label"]))
    expected = {r["label"]: float(i) for i, r in enumerate(order)}
    assert all(expected[r["label"]] == r["label_index"] for r in pairs)
