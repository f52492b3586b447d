"""End-to-end job (E5) on CSV files, and the distributed label path under a
hot label."""

from pyspark.sql import functions as F

from conftest import MALL_FEATURES
from farpoint.functions.alerts import ALERT_PREFIX
from farpoint.operators.features import fit_features
from farpoint.plans.catalogue import staged
from farpoint.plans.job import JobConfig, run_job
from farpoint.session import scratch_path


def test_run_job_csv_to_text(spark, mall):
    clean, planted = mall
    out = scratch_path(spark, "job-alerts")
    cfg = JobConfig(features=MALL_FEATURES, train_path=staged(clean, "csv"),
                    score_path=staged(planted, "csv"), output_path=out,
                    schema="id int, Genre string, Age int, AnnualIncome int, SpendingScore int")
    res = run_job(spark, cfg)
    assert res.found and res.model.k == 4
    lines = sorted(r[0] for r in spark.read.text(out).collect())
    assert lines == [ALERT_PREFIX + "51: [50,Female,18,65,150]",
                     ALERT_PREFIX + "73: [72,Female,150,111,37]"]
    from farpoint.plans.job import console_lines
    assert sorted(console_lines(spark, cfg, res)) == lines
    again = run_job(spark, cfg)                  # appends; console shows this run only
    assert spark.read.text(out).count() == 4
    assert sorted(console_lines(spark, cfg, again)) == lines


def test_hot_label_distributed_path(spark):
    """One label holds 40% of the rows; 2,000 other labels. The distributed
    ranking and shuffle join give the same indexes as the local path."""
    base = spark.range(0, 20000).select(
        F.col("id").cast("int").alias("id"),
        F.when(F.col("id") % 5 < 2, F.lit("HOT"))
         .otherwise(F.concat(F.lit("L"), (F.col("id") % 2003).cast("string"))).alias("label"),
        (F.col("id") % 97).cast("double").alias("x"))
    local = fit_features(base, ["label", "x"])
    dist = fit_features(base, ["label", "x"], max_local_labels=50)
    assert not dist.labels[0].local and local.labels[0].size == dist.labels[0].size
    a = local.index(base).select("id", "label_index")
    b = dist.index(base).select("id", "label_index")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    hot = dist.index(base).where("label = 'HOT'").select("label_index").distinct().collect()
    assert [r[0] for r in hot] == [0.0]
    assert abs(local.stds[1] - dist.stds[1]) < 1e-9 * max(1.0, local.stds[1])


def test_staged_features_give_identical_results(spark, mall):
    """Staging the chosen columns (for row-format sources) changes nothing."""
    from farpoint import train
    from farpoint.sources import read_file
    clean, planted = mall
    train_csv = read_file(spark, staged(clean, "csv"), "csv")
    score_csv = read_file(spark, staged(planted, "csv"), "csv")
    plain = train(train_csv, MALL_FEATURES, "kMeans")
    stage = train(train_csv, MALL_FEATURES, "kMeans", stage_features=True)
    assert stage.k == plain.k and stage.centres == plain.centres
    for refit in (True, False):
        a = plain.detect(score_csv, refit=refit)
        b = plain.detect(score_csv, refit=refit, stage_features=True)
        assert a.threshold == b.threshold
        assert sorted(r["id"] for r in a.flagged.collect()) == \
            sorted(r["id"] for r in b.flagged.collect()) == [50, 72]


def test_run_job_json_files(spark, mall):
    clean, planted = mall
    out = scratch_path(spark, "job-json-alerts")
    cfg = JobConfig(features=MALL_FEATURES, train_path=staged(clean, "json"),
                    score_path=staged(planted, "json"), file_type="json", output_path=out,
                    id_col="id")
    res = run_job(spark, cfg)
    # JSON infers longs and orders columns alphabetically; the id is explicit.
    lines = sorted(r[0] for r in spark.read.text(out).collect())
    assert [line.split(":")[0].split()[-1] for line in lines] == ["51", "73"]
    assert res.model.k == 4


def test_kafka_shaped_rows_decode_then_detect(spark):
    """S5 -> E1/E2: events in the Kafka row shape (no broker here), decoded
    from JSON, then trained on and scored."""
    from farpoint import train
    from farpoint.sources import decode_kafka, to_kafka_rows
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    raw = to_kafka_rows(events, "event_id", ["event_id", "event_type", "value", "user_id"], "ev")
    decoded = decode_kafka(raw, "event_id long, event_type string, value double, user_id long")
    model = train(decoded, ["event_type", "value", "user_id"], "kMeans", k=3)
    direct = train(events, ["event_type", "value", "user_id"], "kMeans", k=3)
    assert model.centres == direct.centres
    a = model.detect(decoded, id_col="event_id").flagged.select("event_id").collect()
    b = direct.detect(events, id_col="event_id").flagged.select("event_id").collect()
    assert sorted(r[0] for r in a) == sorted(r[0] for r in b)


def test_cli_main_subprocess(spark, mall):
    """The command-line job end to end in its own process (E5 + K4)."""
    import os
    import subprocess
    import sys
    clean, planted = mall
    out = scratch_path(spark, "cli-alerts")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    cmd = [sys.executable, "-m", "farpoint.plans.job",
           "--train-path", staged(clean, "csv"), "--score-path", staged(planted, "csv"),
           "--features", *MALL_FEATURES, "--output-path", out,
           "--schema", "id int, Genre string, Age int, AnnualIncome int, SpendingScore int"]
    proc = subprocess.run(cmd, cwd=root, capture_output=True, text=True, timeout=600)
    assert proc.returncode == 0, proc.stderr[-2000:]
    printed = [x for x in proc.stdout.splitlines() if x.startswith(ALERT_PREFIX)]
    assert sorted(printed) == [ALERT_PREFIX + "51: [50,Female,18,65,150]",
                               ALERT_PREFIX + "73: [72,Female,150,111,37]"]
    assert '"found": true' in proc.stdout and '"k": 4' in proc.stdout
    assert sorted(r[0] for r in spark.read.text(out).collect()) == sorted(printed)
