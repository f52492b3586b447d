"""Saved models, jobs that are started again, one-scan detection and offset plans."""

import json
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from conftest import MALL_FEATURES, ROOT, SF_SMALL
from farpoint import storage, train
from farpoint.operators.detection import DistanceStats
from farpoint.operators.features import fit_features
from farpoint.plans import job
from farpoint.plans.catalogue import EVENT_FEATURES, group_centres, staged
from farpoint.plans.job import JobConfig, run_job
from farpoint.plans.model import AnomalyModel
from farpoint.plans.store import load_model, save_model, versions
from farpoint.session import scratch_path
from farpoint.sources import read_file
from farpoint.sources.kafka import plan_offsets

SCHEMA = "id int, Genre string, Age int, AnnualIncome int, SpendingScore int"


def flags(det):
    return sorted(tuple(r) for r in det.flagged.collect())


@pytest.mark.parametrize("algorithm", ["kMeans", "bisectingKMeans"])
def test_a_loaded_model_flags_the_same_rows(spark, mall, algorithm):
    clean, planted = mall
    model = train(clean, MALL_FEATURES, algorithm, k=4, spread=("euclidean",))
    path = scratch_path(spark, "models")
    assert save_model(spark, model, path) == 1 and save_model(spark, model, path) == 2
    again = load_model(spark, path)
    assert versions(spark, path) == [1, 2]
    assert again.centres == model.centres and again.spread == model.spread
    assert again.preparation.stds == model.preparation.stds
    for refit in (True, False):
        a, b = model.detect(planted, refit=refit), again.detect(planted, refit=refit)
        assert a.threshold == b.threshold and flags(a) == flags(b) and flags(a)


@pytest.mark.parametrize("bound", [100_000, 0])
def test_larger_label_tables_are_saved_too(spark, bound):
    customer = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    prep = fit_features(customer, ["c_name", "c_acctbal"], max_local_labels=bound)
    model = AnomalyModel.from_centres("kMeans", ["c_name", "c_acctbal"],
                                      group_centres(prep, customer, "c_nationkey"), prep)
    path = scratch_path(spark, "models")
    save_model(spark, model, path)
    again = load_model(spark, path, 1)
    assert again.preparation.labels[0].local == prep.labels[0].local
    det = model.detect(customer, n_sigma=1.0, refit=False)
    assert flags(det) == flags(again.detect(customer, n_sigma=1.0, refit=False)) and flags(det)


def test_another_session_reads_the_model(spark, mall):
    clean, planted = mall
    model = train(clean, MALL_FEATURES, "kMeans", k=4)
    path, rows = scratch_path(spark, "models"), scratch_path(spark, "rows")
    save_model(spark, model, path)
    planted.write.parquet(rows)
    script = ("from farpoint.session import build_session\n"
              "from farpoint.plans.store import load_model\n"
              "s = build_session('local[2]')\n"
              f"d = load_model(s, {path!r}).detect(s.read.parquet({rows!r}), refit=False)\n"
              "print('FOUND', repr(d.threshold), sorted(r['id'] for r in d.flagged.collect()))\n")
    done = subprocess.run([sys.executable, "-c", script], cwd=ROOT, capture_output=True,
                          text=True, timeout=300)
    assert f"FOUND {model.detect(planted, refit=False).threshold!r} [50, 72]" in done.stdout, \
        done.stderr[-2000:]


def test_missing_and_half_written_models(spark, mall):
    path = scratch_path(spark, "models")
    with pytest.raises(ValueError, match="no saved model"):
        load_model(spark, path)
    storage.write_json(spark, f"{path}/_draft-x/model.json", {"format": 1})
    with pytest.raises(ValueError, match="no saved model"):
        load_model(spark, path)
    storage.write_json(spark, f"{path}/v-1/model.json", {"format": 99})
    with pytest.raises(ValueError, match="format 99"):
        load_model(spark, path)


def config(mall, spark, **more):
    clean, planted = mall
    return JobConfig(features=MALL_FEATURES, train_path=staged(clean, "csv"), schema=SCHEMA,
                     score_path=staged(planted, "csv"), run_dir=scratch_path(spark, "run"),
                     output_path=scratch_path(spark, "alerts"), **more)


def test_a_job_stopped_after_training_does_not_train_again(spark, mall, monkeypatch):
    cfg = config(mall, spark)
    with monkeypatch.context() as broken:
        def stop(*_, **__):
            raise RuntimeError("driver lost")
        broken.setattr(AnomalyModel, "detect", stop)
        with pytest.raises(RuntimeError):
            run_job(spark, cfg)

    def never(*_, **__):
        raise AssertionError("trained again")
    monkeypatch.setattr(job, "train", never)
    res = run_job(spark, cfg)
    assert res.resumed and res.model.k == 4 and res.records["train"].records == 200
    assert spark.read.text(cfg.output_path).count() == 2
    again = run_job(spark, cfg)                    # finished: its lines are not written twice
    assert again.resumed and again.new_files == res.new_files
    assert spark.read.text(cfg.output_path).count() == 2


def test_a_run_folder_belongs_to_one_job(spark, mall):
    cfg = config(mall, spark, k=4)
    run_job(spark, cfg)
    cfg.n_sigma = 2.0
    with pytest.raises(ValueError, match="other settings"):
        run_job(spark, cfg)


@pytest.mark.parametrize("known,scans", [(True, 1), (False, 1), ("high", 2)])
def test_one_scan_gives_the_same_flags(spark, mall, known, scans):
    clean, planted = mall
    model = train(clean, MALL_FEATURES, "kMeans", k=4, spread=("euclidean",))
    if known == "high":           # a bound above the real cut: the exact second scan
        model.spread["euclidean"] = DistanceStats(200, 1e9, 1e9, 1e9)
    elif not known:
        model.spread.clear()
    rows = read_file(spark, staged(planted, "csv"), "csv", schema=SCHEMA)
    plain = model.detect(rows, refit=False)
    once = model.detect(rows, refit=False, one_scan=True)
    assert once.scans == scans and once.threshold == plain.threshold
    assert once.flagged.columns == plain.flagged.columns
    assert flags(once) == flags(plain) and [r[0] for r in flags(once)] == [50, 72]
    assert sorted(r[0] for r in once.alerts().collect()) == sorted(
        r[0] for r in plain.alerts().collect())
    read = once.flagged._jdf.queryExecution().executedPlan().toString()
    assert ("Scan csv" in read) == (scans == 2)    # else flagged rows come from the one scan
    if scans == 1:
        assert storage.exists(spark, once.staged)
        once.drop()
        assert not storage.exists(spark, once.staged)


def test_one_scan_reads_the_source_once(spark, mall, tmp_path):
    """The source is gone after the scan; statistics and flags are still there."""
    clean, planted = mall
    model = train(clean, MALL_FEATURES, "kMeans", k=4, spread=("manhattan",))
    path = staged(planted, "csv")
    det = model.detect(read_file(spark, path, "csv", schema=SCHEMA), "manhattan", refit=False,
                       one_scan=True)
    storage.remove(spark, path)
    assert [r[0] for r in flags(det)] == [50, 72] and det.found()


def test_one_scan_needs_a_fitted_preparation(spark, mall):
    model = train(mall[0], MALL_FEATURES, "kMeans", k=4)
    with pytest.raises(ValueError, match="one_scan"):
        model.detect(mall[1], one_scan=True)
    with pytest.raises(ValueError, match="one_scan"):
        model.detect(mall[1], one_scan=True, refit=False, rule="sqrt")
    empty = model.detect(mall[1].where("false"), one_scan=True, refit=False)
    assert flags(empty) == [] and not empty.found()
    holes = mall[1].withColumn("Age", F.when(F.col("id") != 3, F.col("Age")))
    with pytest.raises(ValueError, match="null or NaN"):
        model.detect(holes, one_scan=True, refit=False)


def test_job_without_refit_reads_the_scored_file_once(spark, mall):
    cfg = config(mall, spark, refit=False)
    res = run_job(spark, cfg)
    assert res.detection.scans == 1 and res.records["score"].records == 200
    assert spark.read.text(cfg.output_path).count() == 2


def test_offset_plan_lists_empty_partitions():
    plan = plan_offsets({"t": {0: 10, 2: 0, 1: 3}})
    assert json.loads(plan) == {"t": {"0": 10, "1": 3, "2": 0}}


def test_events_one_scan_over_many_files(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    prep = fit_features(events, EVENT_FEATURES)
    model = AnomalyModel.from_centres("kMeans", EVENT_FEATURES,
                                      group_centres(prep, events, "event_type"), prep)
    a = model.detect(events.repartition(9), refit=False, id_col="event_id", n_sigma=1.0)
    b = model.detect(events.repartition(4), refit=False, id_col="event_id", n_sigma=1.0,
                     one_scan=True)
    ids = lambda det: sorted(r["event_id"] for r in det.flagged.collect())
    assert a.threshold == b.threshold and ids(a) == ids(b) and ids(a)
