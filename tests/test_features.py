"""Feature preparation: indexing order, null skip, scaling, layout, errors."""

import math

import pytest
from pyspark.sql import functions as F

from farpoint.operators.features import fit_features, split_features


def _index_map(prep, df, col):
    rows = prep.index(df).select(col, f"{col}_index").distinct().collect()
    return {r[0]: r[1] for r in rows}


def test_index_frequency_then_alphabetical(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "a"), (4, "b"), (5, "c")], "id int, g string")
    prep = fit_features(df, ["g"])
    assert _index_map(prep, df, "g") == {"a": 0.0, "b": 1.0, "c": 2.0}


def test_null_string_row_dropped_ids_kept(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (2, None, 2.0), (3, "y", 3.0), (4, "x", 4.0)],
                               "id int, g string, v double")
    prep = fit_features(df, ["g", "v"])
    out = prep.index(df).orderBy("id").collect()
    assert [r["id"] for r in out] == [1, 3, 4]
    assert [r["v"] for r in out] == [1.0, 3.0, 4.0]
    assert prep.rows_seen == 4 and prep.rows_kept == 3


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(float(i), 5.0) for i in range(10)], "x double, k double")
    prep = fit_features(df, ["x", "k"])
    assert prep.factors[1] == 0.0
    vals = prep.transform(df).select("f_5").distinct().collect()
    assert [r[0] for r in vals] == [0.0]


def test_3n_layout_and_order(spark):
    df = spark.createDataFrame([("a", 1.0, 2), ("b", 2.0, 4), ("a", 4.0, 1)],
                               "s string, x double, y int")
    prep = fit_features(df, ["s", "x", "y"])
    assert prep.base_columns == ["x", "y", "s_index"]
    assert prep.dimension == 9
    v = prep.vectors(df).first()["features"]
    assert len(v) == 9
    assert list(v[0:3]) == list(v[3:6])


def test_scaled_layout_option(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    prep = fit_features(df, ["x"], layout="scaled")
    assert prep.dimension == 1
    with pytest.raises(ValueError):
        fit_features(df, ["x"], layout="other")


def test_numeric_null_is_error(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    with pytest.raises(ValueError, match="null"):
        fit_features(df, ["x"])


def test_numeric_nan_is_error(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    with pytest.raises(ValueError, match="NaN"):
        fit_features(df, ["x"])


def test_timestamp_feature_rejected(spark):
    df = spark.createDataFrame([(1,)], "x int").select(F.current_timestamp().alias("ts"))
    with pytest.raises(ValueError, match="only numeric"):
        fit_features(df, ["ts"])


def test_unknown_feature_rejected(spark):
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError, match="unknown feature"):
        split_features(df, ["nope"])


def test_one_row_std_zero(spark):
    df = spark.createDataFrame([(2.5,)], "x double")
    prep = fit_features(df, ["x"])
    assert prep.stds == [0.0]


def test_boolean_and_decimal_features(spark):
    df = spark.createDataFrame([(True, 1.5), (False, 2.5), (True, 4.0)], "b boolean, d double")
    df = df.withColumn("d", F.col("d").cast("decimal(10,2)"))
    prep = fit_features(df, ["b", "d"])
    rows = prep.transform(df).select("f_0", "f_1").collect()
    assert sorted(r[0] for r in rows) == [0.0, 1.0, 1.0]


def test_prefix_rule_matches_sequential_mllib(spark):
    """Two string columns indexed in sequence, like the reference's loop of
    StringIndexers with skip: the second column's counts exclude rows whose
    first column is null."""
    from pyspark.ml.feature import StringIndexer
    data = [("a", "p"), ("a", "q"), (None, "q"), (None, "q"), ("b", "p"), ("b", "p"), ("a", None)]
    df = spark.createDataFrame(data, "s1 string, s2 string")
    ref = df
    for c in ["s1", "s2"]:
        ref = StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="skip").fit(ref).transform(ref)
    expect = sorted((r["s1"], r["s2"], r["s1_index"], r["s2_index"]) for r in ref.collect())
    prep = fit_features(df, ["s1", "s2"])
    got = sorted((r["s1"], r["s2"], r["s1_index"], r["s2_index"]) for r in prep.index(df).collect())
    assert got == expect


def test_distributed_labels_equal_local(spark):
    """Force the large-cardinality path (distributed ranking + shuffle join)."""
    customer = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    df = customer.withColumn("c_name", F.when(F.col("c_acctbal") > 0, F.col("c_name")))
    local = fit_features(df, ["c_mktsegment", "c_name", "c_acctbal"])
    dist = fit_features(df, ["c_mktsegment", "c_name", "c_acctbal"], max_local_labels=3)
    assert all(t.local for t in local.labels) and not any(t.local for t in dist.labels)
    cols = ["c_custkey", "c_mktsegment_index", "c_name_index"]
    a = sorted(tuple(r) for r in local.index(df).select(*cols).collect())
    b = sorted(tuple(r) for r in dist.index(df).select(*cols).collect())
    assert a == b
    assert all(math.isclose(x, y, rel_tol=1e-12) for x, y in zip(local.stds, dist.stds))


def test_label_byte_bounds_choose_tier(spark, monkeypatch):
    """Few but long labels: the byte bounds, not only the counts, pick the tier."""
    from farpoint.operators import features as feat
    from farpoint.operators import indexing
    customer = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    monkeypatch.setattr(indexing, "INLINE_LABELS", 1024)
    base = fit_features(customer, ["c_name", "c_acctbal"])
    assert base.labels[0].mapping is not None                      # inline
    monkeypatch.setattr(indexing, "INLINE_LABEL_BYTES", 100)
    mid = fit_features(customer, ["c_name", "c_acctbal"])
    assert mid.labels[0].mapping is None and mid.labels[0].local     # broadcast join
    monkeypatch.setattr(feat, "MAX_LOCAL_LABEL_BYTES", 100)
    big = fit_features(customer, ["c_name", "c_acctbal"])
    assert not big.labels[0].local                                  # distributed
    cols = ["c_custkey", "c_name_index"]
    want = sorted(tuple(r) for r in base.index(customer).select(*cols).collect())
    for prep in (mid, big):
        assert sorted(tuple(r) for r in prep.index(customer).select(*cols).collect()) == want


def test_unicode_tie_order_matches_mllib(spark):
    """Equal counts are ordered like MLlib's StringIndexer, also for labels
    outside the basic plane (both the local and the distributed tier)."""
    from pyspark.ml.feature import StringIndexer
    labels = ["Ａ", "\U0001F600", "b", "a", "é"]
    df = spark.createDataFrame([(i, l) for i, l in enumerate(labels)], "id int, s string")
    want = {l: float(i) for i, l in enumerate(StringIndexer(inputCol="s", outputCol="i")
                                               .fit(df).labels)}
    for bound in (100, 0):
        prep = fit_features(df, ["s"], max_local_labels=bound)
        got = {r["s"]: r["s_index"] for r in prep.index(df).collect()}
        assert got == want
