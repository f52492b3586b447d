"""Scoring a stream in micro-batches.

The reference reads Kafka as one bounded batch. ``detect_each_batch`` runs
the same detection on every micro-batch of a streaming DataFrame through
``foreachBatch``: each batch is one scored table, so its threshold is that
batch's mean + n sigma, which is what the reference computes per table. No
streaming state or watermark is involved. Pass a stable ``checkpoint`` path
(on shared storage) for a query that resumes where it stopped after a
restart; without one, a fresh folder under the shared checkpoint folder is
used for this run only.

Spark may hand over a micro-batch again after a failure. Its lines are committed under
the checkpoint and the batch's number, so the file sink gets them once; a batch that was
committed is not scored again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.features import fit_features
from ..plans.model import AnomalyModel, Detection
from ..session import scratch_path
from ..sinks import is_committed, write_alerts


def detect_each_batch(model: AnomalyModel, stream: DataFrame, *, metric: str = "euclidean",
                      n_sigma: float | None = None, refit: bool = True,
                      id_col: str | None = None, output: str = "file",
                      path: str | None = None, brokers: str | None = None,
                      topic: str | None = None, checkpoint: str | None = None,
                      on_batch: Callable[[Detection, int], None] | None = None,
                      trigger: dict | None = None) -> StreamingQuery:
    """Start a streaming query that writes each batch's alert lines."""
    if not stream.isStreaming:
        raise ValueError("detect_each_batch needs a streaming DataFrame")

    ckpt = checkpoint or scratch_path(stream.sparkSession, "stream-checkpoint")
    name = hashlib.sha256(ckpt.rstrip("/").encode()).hexdigest()[:16]

    def handle(batch: DataFrame, epoch: int) -> None:
        commit = f"{name}-{epoch}"
        if output.lower() == "file" and path and is_committed(batch.sparkSession, path, commit):
            return
        # The batch is read by the refit, the statistics and the alert write.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        prep = None
        try:
            if batch.isEmpty():
                return
            if refit:
                prep = fit_features(batch, model.features, layout=model.preparation.layout)
            det = model.detect(batch, metric, n_sigma=n_sigma, refit=refit, id_col=id_col,
                               preparation=prep)
            write_alerts(det.alerts(), output, path=path, brokers=brokers, topic=topic,
                         commit=commit)
            if on_batch is not None:
                on_batch(det, epoch)
        finally:
            batch.unpersist()
            if prep is not None:
                prep.drop()

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", ckpt)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
