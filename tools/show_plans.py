"""Print the formatted physical plans of the main operators (sf0.01)."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from farpoint.operators.detection import stats_rows  # noqa: E402
from farpoint.operators.features import fit_features, fit_statistics  # noqa: E402
from farpoint.plans.catalogue import EVENT_FEATURES, group_centres, table  # noqa: E402
from farpoint.plans.model import AnomalyModel  # noqa: E402
from farpoint.session import build_session  # noqa: E402


def show(title, df):
    print(f"\n### {title}\n")
    print(df._jdf.queryExecution().executedPlan().treeString())


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    events = table(spark, sf, "events")
    show("fit statistics (one scan)", fit_statistics(events, ["value", "user_id"], ["event_type"]))
    prep = fit_features(events, EVENT_FEATURES)
    model = AnomalyModel.from_centres("kMeans", EVENT_FEATURES,
                                      group_centres(prep, events, "event_type"), prep)
    scored, _ = model.score(events, preparation=prep)
    show("distance statistics", stats_rows(scored))
    det = model.detect(events, preparation=prep, id_col="event_id")
    show("flagged alert lines", det.alerts())
    customer = table(spark, sf, "customer")
    mid = fit_features(customer, ["c_name", "c_acctbal"])
    show("mid-size label set (broadcast join)", mid.index(customer).select("c_custkey", "c_name_index"))
    big = fit_features(customer, ["c_name", "c_acctbal"], max_local_labels=10)
    show("large label set (shuffle join)", big.index(customer).select("c_custkey", "c_name_index"))
    show("training coordinates", prep.vectors(events))
