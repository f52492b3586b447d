"""Committed text: a replay, a torn attempt and a resumed stream leave the same lines."""

import pytest

from conftest import MALL_FEATURES, MALL_SCHEMA, mall_rows
from farpoint import storage, train
from farpoint.operators.features import fit_features
from farpoint.session import scratch_path
from farpoint.sinks import commit as op
from farpoint.sinks import commit_text, committed_lines, is_committed, write_alerts
from farpoint.streaming import detect_each_batch


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string").repartition(3)


def read(spark, path):
    return sorted(r[0] for r in spark.read.text(path).collect())


def test_a_replay_adds_nothing(spark):
    path = scratch_path(spark, "commits")
    files = commit_text(lines(spark, "a", "b", "c"), path, "run-0")
    assert commit_text(lines(spark, "a", "b", "c"), path, "run-0") == files
    write_alerts(lines(spark, "d"), "file", path=path, commit="run-1")
    write_alerts(lines(spark, "d"), "file", path=path, commit="run-1")
    assert read(spark, path) == ["a", "b", "c", "d"]
    assert sorted(r[0] for r in committed_lines(spark, path).collect()) == ["a", "b", "c", "d"]
    assert is_committed(spark, path, "run-0") and not is_committed(spark, path, "run-2")


def test_an_attempt_that_stopped_half_way_is_replaced(spark, monkeypatch):
    path = scratch_path(spark, "commits")
    commit_text(lines(spark, "before"), path, "e-1")
    with monkeypatch.context() as broken:
        def stop(*_):
            raise RuntimeError("driver lost")
        broken.setattr(op.storage, "publish_json", stop)
        with pytest.raises(RuntimeError):
            commit_text(lines(spark, "x", "y", "z"), path, "e-12")
    assert not is_committed(spark, path, "e-12")
    # what the commit log lists never shows part of a commit
    assert [r[0] for r in committed_lines(spark, path).collect()] == ["before"]
    commit_text(lines(spark, "x", "y", "z"), path, "e-12")
    assert read(spark, path) == ["before", "x", "y", "z"]


def test_no_lines_and_bad_ids(spark):
    path = scratch_path(spark, "commits")
    assert committed_lines(spark, path).collect() == []
    commit_text(lines(spark), path, "none")
    assert is_committed(spark, path, "none") and committed_lines(spark, path).collect() == []
    for bad in ("", "a/b", "../x", "a--b", "_x"):
        with pytest.raises(ValueError, match="commit id"):
            commit_text(lines(spark, "a"), path, bad)


def test_published_files_are_whole_and_stay(spark):
    path = f"{scratch_path(spark, 'json')}/f.json"
    assert storage.publish_json(spark, path, {"ü": 1})
    assert not storage.publish_json(spark, path, {"ü": 2})
    assert storage.read_json(spark, path) == {"ü": 1}


def test_a_replayed_micro_batch_leaves_the_same_lines(spark, mall, monkeypatch):
    """The query stops after a batch's lines were written and before Spark noted the batch;
    started again, it gets the same batch."""
    model = train(mall[0], MALL_FEATURES, "kMeans", k=4)
    src, out, ckpt = (scratch_path(spark, n) for n in ("src", "alerts", "ckpt"))
    spark.createDataFrame(mall_rows(True), MALL_SCHEMA).coalesce(1).write.parquet(src)
    seen = []

    def run(on_batch):
        stream = spark.readStream.schema(MALL_SCHEMA).parquet(src)
        q = detect_each_batch(model, stream, path=out, checkpoint=ckpt, on_batch=on_batch,
                              trigger={"availableNow": True})
        q.awaitTermination(120)

    def lost(det, epoch):
        seen.append(epoch)
        raise RuntimeError("driver lost")
    with pytest.raises(Exception, match="driver lost"):
        run(lost)
    once = read(spark, out)
    assert len(once) == 2
    run(lambda det, epoch: seen.append(epoch))
    assert read(spark, out) == once and seen == [0]      # not even scored again
    spark.createDataFrame(mall_rows(True), MALL_SCHEMA).coalesce(1).write.mode("append").parquet(src)
    run(lambda det, epoch: seen.append(epoch))
    assert len(read(spark, out)) == 4 and seen == [0, 1]


def test_label_tables_of_a_batch_are_dropped(spark):
    rows = spark.createDataFrame([(i, f"s{i % 7}", float(i)) for i in range(50)],
                                 "id int, s string, x double")
    prep = fit_features(rows, ["s", "x"], max_local_labels=0)
    path = prep.labels[0].path
    assert storage.exists(spark, path)
    prep.drop()
    assert not storage.exists(spark, path)
