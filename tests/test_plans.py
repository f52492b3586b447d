"""Physical-plan properties that matter at scale."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from farpoint.operators.detection import stats_rows
from farpoint.operators.features import fit_features, fit_statistics
from farpoint.plans.catalogue import EVENT_FEATURES, group_centres, table
from farpoint.plans.model import AnomalyModel

SF_MID = "/root/testdata/sf0.01"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _model(spark):
    events = table(spark, SF_SMALL, "events")
    prep = fit_features(events, EVENT_FEATURES)
    centres = group_centres(prep, events, "event_type")
    return AnomalyModel.from_centres("kMeans", EVENT_FEATURES, centres, prep), events


def test_fit_statistics_one_scan_partial_aggregate(spark):
    events = table(spark, SF_SMALL, "events")
    stats = fit_statistics(events, ["value", "user_id"], ["event_type"])
    plan = _plan(stats)
    assert plan.count("HashAggregate") == 2          # map-side partial + final
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1
    assert "ts" not in plan.split("FileScan")[1].split("]")[0]   # pruned scan


def test_scoring_stats_plan_is_pruned_and_shuffle_free(spark):
    model, events = _model(spark)
    scored, _ = model.score(events, preparation=model.preparation)
    plan = _plan(stats_rows(scored))
    scan_cols = plan.split("FileScan")[1].split("]")[0]
    assert "props" not in scan_cols and "ts" not in scan_cols      # features only
    assert "Join" not in plan                       # inline label lookup
    assert "EvalPython" not in plan                 # no Python in the hot path
    assert plan.count("Exchange") == 1 and "hashpartitioning(e#" in plan    # one row per exponent
    assert plan.count("HashAggregate") == 2


def test_flagged_plan_has_no_shuffle(spark):
    model, events = _model(spark)
    det = model.detect(events, preparation=model.preparation, id_col="event_id")
    plan = _plan(det.alerts())
    assert "Exchange" not in plan and "EvalPython" not in plan


def test_mid_tier_labels_use_broadcast_join(spark):
    customer = table(spark, SF_MID, "customer")
    prep = fit_features(customer, ["c_name", "c_acctbal"])     # 1,500 labels > inline size
    t = prep.labels[0]
    assert t.local and t.mapping is None and t.size > 1024
    assert "BroadcastHashJoin" in _plan(prep.index(customer))


def test_small_label_sets_are_inline(spark):
    customer = table(spark, SF_SMALL, "customer")
    prep = fit_features(customer, ["c_mktsegment", "c_acctbal"])
    assert prep.labels[0].mapping is not None
    plan = _plan(prep.index(customer))
    assert "Join" not in plan and "Exchange" not in plan
