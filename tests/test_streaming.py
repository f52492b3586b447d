"""Micro-batch scoring of a file stream with foreachBatch."""

from conftest import MALL_FEATURES, MALL_SCHEMA, mall_rows
from farpoint import train
from farpoint.session import scratch_path
from farpoint.streaming import detect_each_batch


def test_stream_batches_flag_planted_rows(spark, mall):
    clean, _ = mall
    model = train(clean, MALL_FEATURES, "kMeans")
    src = scratch_path(spark, "stream-src")
    spark.createDataFrame(mall_rows(True), MALL_SCHEMA).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(MALL_SCHEMA).parquet(src)
    out = scratch_path(spark, "stream-alerts")
    seen = []
    q = detect_each_batch(model, stream, path=out, trigger={"availableNow": True},
                          on_batch=lambda det, epoch: seen.append(det.threshold))
    q.awaitTermination(120)
    lines = sorted(r[0] for r in spark.read.text(out).collect())
    assert len(seen) == 1
    assert [line.split(":")[0][-2:] for line in lines] == ["51", "73"]


def test_detect_rejects_streaming_frames(spark, mall):
    import pytest
    clean, _ = mall
    model = train(clean, MALL_FEATURES, "kMeans", k=4)
    src = scratch_path(spark, "stream-src2")
    clean.write.parquet(src)
    stream = spark.readStream.schema(MALL_SCHEMA).parquet(src)
    with pytest.raises(ValueError, match="detect_each_batch"):
        model.detect(stream)
    with pytest.raises(ValueError, match="batch DataFrame"):
        train(stream, MALL_FEATURES)
    with pytest.raises(ValueError, match="streaming DataFrame"):
        detect_each_batch(model, clean)
