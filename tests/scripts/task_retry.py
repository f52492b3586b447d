"""Run train + detect while the first attempt of input tasks fails.

Started in its own process with master local[2,4] (tasks may be retried up
to 4 times). Prints a JSON line with the flagged ids and thresholds of a
clean run and of the run with injected failures.
"""

import json
import os
import sys
import tempfile
import uuid

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from conftest import MALL_FEATURES, MALL_SCHEMA, mall_rows  # noqa: E402
from farpoint import build_session, train  # noqa: E402


MARKS = tempfile.mkdtemp(prefix="task-retry-marks-")   # local test process only


def flaky(x):
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0:
        open(os.path.join(MARKS, uuid.uuid4().hex), "w").close()   # count the failure
        raise RuntimeError("injected task failure")
    return x


def run(spark, fail: bool):
    clean = spark.createDataFrame(mall_rows(), MALL_SCHEMA).coalesce(1)
    planted = spark.createDataFrame(mall_rows(True), MALL_SCHEMA).coalesce(1)
    if fail:
        bad = F.udf(flaky, "int")
        clean = clean.withColumn("Age", bad("Age"))
        planted = planted.withColumn("Age", bad("Age"))
    model = train(clean, MALL_FEATURES, "kMeans")
    det = model.detect(planted)
    return {"k": model.k, "flagged": sorted(r["id"] for r in det.flagged.collect()),
            "threshold": det.threshold}


if __name__ == "__main__":
    spark = build_session("local[2,4]", "task-retry", shuffle_partitions=2)
    out = {"clean": run(spark, False), "failing": run(spark, True)}
    out["injected_failures"] = len(os.listdir(MARKS))
    spark.stop()
    print("RESULT " + json.dumps(out))
