"""Throughput probe on a larger copy of events (not part of the query set).

Usage: python tools/scale_probe.py [copies] [cpus]
Writes `copies` copies of sf0.1 events (fresh event ids, same schema) to the
scratch area, then times the preparation fit, the scoring statistics, the
flagged-row write and a full train (k search) on it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from farpoint.operators.features import fit_features  # noqa: E402
from farpoint.plans.catalogue import EVENT_FEATURES, table  # noqa: E402
from farpoint.plans.model import train  # noqa: E402
from farpoint.session import build_session, drop_path, scratch_path  # noqa: E402


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 50
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    spark = build_session(f"local[{cpus}]", "farpoint-scale", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    events = table(spark, "/root/testdata/sf0.1", "events")
    n = events.count()
    big_path = scratch_path(spark, "scale-events")
    (events.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"))
     .withColumn("event_id", F.col("copy") * F.lit(n) + F.col("event_id")).drop("copy")
     .repartition(cpus * 4).write.parquet(big_path))
    big = spark.read.parquet(big_path)
    rows = big.count()
    out = {"rows": rows, "cpus": cpus}

    def timed(name, fn):
        t0 = time.perf_counter()
        r = fn()
        out[name] = round(time.perf_counter() - t0, 2)
        return r

    prep = timed("fit_features", lambda: fit_features(big, EVENT_FEATURES))
    model = timed("train_kmeans", lambda: train(big, EVENT_FEATURES, "kMeans"))
    out["k"] = model.k
    det = timed("detect_stats", lambda: model.detect(big, preparation=prep, id_col="event_id"))
    timed("flagged_alerts_write", lambda: det.alerts().write.format("noop").mode("overwrite").save())
    timed("detect_refit_total", lambda: model.detect(big, id_col="event_id")
          .alerts().write.format("noop").mode("overwrite").save())
    out["scored_rows_per_sec"] = round(rows / (out["detect_stats"] + out["flagged_alerts_write"]))
    drop_path(spark, big_path)
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
