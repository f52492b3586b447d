"""Driver contract: entry(), queries(), oracle_sql() and the DuckDB check."""

import __spark_entry__ as entry
from farpoint.plans.catalogue import QUERIES
from conftest import SF_SMALL

FAST = ["csv_scan", "json_scan", "kafka_decode", "column_names", "preview", "schema_fields",
        "feature_select", "string_columns", "string_index", "index_distributed",
        "index_skip_nulls", "index_chain",
        "standard_scale", "feature_layout", "nearest_euclidean", "nearest_manhattan",
        "nearest_centre", "distance_stats", "detect_kmeans_rule_euclid",
        "detect_kmeans_rule_manhattan", "detect_bisecting_rule_euclid",
        "detect_bisecting_rule_manhattan", "any_anomaly", "sqrt_rule", "alert_text",
        "flagged_alerts", "text_sink_append", "silhouette", "silhouette_events",
        "silhouettes_all_k", "kafka_bad_records", "text_sink_replay", "detect_one_scan",
        "saved_model",
        "kmeans_fit", "bisecting_fit"]


def test_contract_keys():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert set(QUERIES) <= set(qs)
    assert set(QUERIES) - set(sql) == {"train_detect_kmeans", "train_detect_bisecting"}


def test_entry_flags_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_id", "distance"]
    assert df.count() > 0


def test_oracle_agreement_small(spark):
    from tools.compare_oracle import compare
    res = compare(spark, SF_SMALL, FAST)
    bad = {n: r for n, r in res.items()
           if "error" in r or not (r.get("values_match") and r.get("cols_match"))}
    assert not bad, bad
