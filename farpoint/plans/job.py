"""End-to-end job (E5): read → train → read → detect → write alerts.

Run as ``python -m farpoint.plans.job --train-path a.csv --score-path b.csv
--features Genre Age AnnualIncome SpendingScore --output-path alerts/``.
Input and output topics are separate settings (the reference shares one).

Records that cannot be read are counted, and written to ``bad_records_path`` if one is
given. With a ``run_dir`` on shared storage a job can be started again after it stopped:
a finished training is not repeated, and its alert lines are written once.
"""

from __future__ import annotations

import argparse
import hashlib
import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions.alerts import NONE_FOUND
from ..session import list_files
from ..sinks import all_lines, commit_text, write_alerts
from ..sources import checked_source, read_source
from ..sources.checked import Checked, Counts
from ..sources.kafka import plan_offsets, topic_ends
from .model import AnomalyModel, Detection, train
from .store import load_model, save_model


@dataclass
class JobConfig:
    features: list[str]
    train_path: str | None = None
    score_path: str | None = None
    source: str = "file"
    file_type: str = "csv"
    brokers: str | None = None
    input_topic: str | None = None
    score_topic: str | None = None
    value_schema: str | None = None
    schema: str | None = None            # DDL for file sources: skips CSV inference
    sampling_ratio: float | None = None  # or infer CSV types from a sample
    algorithm: str = "kMeans"
    metric: str = "euclidean"
    n_sigma: float | None = None
    rule: str = "sigma"
    refit: bool = True
    layout: str = "3n"
    id_col: str | None = None
    k: int | None = None
    output: str = "file"
    output_path: str | None = None
    output_topic: str | None = None
    console_limit: int | None = None      # None: every alert line
    starting_offsets: str | None = None
    ending_offsets: str | None = None
    kafka_options: dict[str, str] | None = None
    bad_records_path: str | None = None   # unreadable records, as JSON lines
    run_dir: str | None = None            # for a job that can be started again


@dataclass
class JobResult:
    model: AnomalyModel
    detection: Detection
    found: bool
    new_files: list[str] | None = None   # part files this run appended (file sink)
    records: dict[str, Counts] = field(default_factory=dict)   # read and bad, by table
    resumed: bool = False                # the model came from an earlier start


class RunLedger:
    """What a job has finished, in its run folder.

    One small file for each finished stage, published whole, and the fingerprint of the
    settings that shape the result: a folder of another job is refused.
    """

    # settings that change where output goes or how it is shown, not what a stage makes
    FREE = ("console_limit", "bad_records_path", "run_dir")

    def __init__(self, spark: SparkSession, cfg: JobConfig):
        self.spark, self.path = spark, cfg.run_dir.rstrip("/")
        shaped = {k: v for k, v in asdict(cfg).items() if k not in self.FREE}
        self.fingerprint = hashlib.sha256(
            json.dumps(shaped, sort_keys=True).encode()).hexdigest()
        storage.publish_json(spark, f"{self.path}/job.json",
                             {"fingerprint": self.fingerprint, "settings": shaped})
        if storage.read_json(spark, f"{self.path}/job.json")["fingerprint"] != self.fingerprint:
            raise ValueError(f"{self.path} belongs to a job with other settings")

    def finished(self, stage: str) -> dict | None:
        at = f"{self.path}/{stage}.json"
        return storage.read_json(self.spark, at) if storage.exists(self.spark, at) else None

    def finish(self, stage: str, **facts) -> None:
        storage.publish_json(self.spark, f"{self.path}/{stage}.json", facts)

    def commit(self, name: str) -> str:
        return f"{name}-{self.fingerprint[:16]}"


def _source(spark: SparkSession, cfg: JobConfig, path: str | None, topic: str | None,
            ending: str | None) -> tuple[DataFrame, Checked | None]:
    """The table to read; for row formats with every bad record accounted for."""
    settings = dict(path=path, file_type=cfg.file_type, brokers=cfg.brokers, topic=topic,
                    value_schema=cfg.value_schema, schema=cfg.schema,
                    sampling_ratio=cfg.sampling_ratio, starting_offsets=cfg.starting_offsets,
                    ending_offsets=ending, options=cfg.kafka_options)
    checked = checked_source(spark, cfg.source, **settings)
    if checked is not None:
        return checked.rows, checked
    return read_source(spark, cfg.source, **settings), None


def _account(spark: SparkSession, cfg: JobConfig, name: str, checked: Checked | None,
             was_read: bool, ledger: RunLedger | None) -> dict[str, Counts]:
    """Counts of a table's records; its bad ones are written if a path is set."""
    if checked is None:
        return {}
    counts = checked.observed() if was_read else checked.counts()
    if counts.bad and cfg.bad_records_path:
        lines = checked.bad.select(F.to_json(F.struct(F.lit(name).alias("table"), "*"))
                                   .alias("value"))
        if ledger is not None:
            commit_text(lines, cfg.bad_records_path, ledger.commit(f"bad-{name}"))
        else:
            lines.write.mode("append").text(cfg.bad_records_path)
    return {name: counts}


def _trained(spark: SparkSession, cfg: JobConfig, row_format: bool, ledger: RunLedger | None
             ) -> tuple[AnomalyModel, dict[str, Counts], bool]:
    """The model: trained now, or the one an earlier start of this run saved."""
    done = ledger.finished("train") if ledger is not None else None
    if done is not None:
        model = load_model(spark, f"{ledger.path}/model", done["version"])
        return model, {t: Counts(*c) for t, c in done["records"].items()}, True
    rows, checked = _source(spark, cfg, cfg.train_path, cfg.input_topic, cfg.ending_offsets)
    model = train(rows, cfg.features, cfg.algorithm, k=cfg.k, layout=cfg.layout,
                  stage_features=row_format, spread=() if cfg.refit else (cfg.metric,))
    records = _account(spark, cfg, "train", checked, row_format, ledger)
    if ledger is not None:
        version = save_model(spark, model, f"{ledger.path}/model")
        ledger.finish("train", version=version,
                      records={t: [c.records, c.bad] for t, c in records.items()})
    return model, records, False


def run_job(spark: SparkSession, cfg: JobConfig, *, write: bool = True) -> JobResult:
    # Row formats are parsed in full on every pass: stage the chosen columns.
    row_format = cfg.source.lower() == "kafka" or cfg.file_type.lower() in ("csv", "json")
    ledger = RunLedger(spark, cfg) if cfg.run_dir else None
    model, records, resumed = _trained(spark, cfg, row_format, ledger)
    topic = cfg.score_topic or cfg.input_topic
    ending = cfg.ending_offsets
    if cfg.source.lower() == "kafka" and ending is None:
        # the statistics and the flag pass must read the same records of a live topic
        ending = plan_offsets(topic_ends(spark, cfg.brokers or "", topic or "",
                                         cfg.kafka_options))
    score_df, checked = _source(spark, cfg, cfg.score_path, topic, ending)
    # without a refit the source is read once, with one the narrow staged copy is
    once = row_format and not cfg.refit and cfg.rule.lower() == "sigma"
    det = model.detect(score_df, cfg.metric, n_sigma=cfg.n_sigma, refit=cfg.refit,
                       rule=cfg.rule, id_col=cfg.id_col, stage_features=row_format,
                       one_scan=once)
    was_read = row_format and (cfg.refit or cfg.rule.lower() == "sigma")
    records |= _account(spark, cfg, "score", checked, was_read, ledger)
    new_files = None
    if write:
        to_file = cfg.output.lower() == "file" and cfg.output_path
        if to_file and ledger is not None:
            new_files = commit_text(det.alerts(), cfg.output_path, ledger.commit("alerts"))
        else:
            before = list_files(spark, cfg.output_path) if to_file else set()
            write_alerts(det.alerts(), cfg.output, path=cfg.output_path, brokers=cfg.brokers,
                         topic=cfg.output_topic)
            if to_file:
                new_files = sorted(list_files(spark, cfg.output_path) - before)
        if ledger is not None:
            ledger.finish("write", threshold=det.threshold)
    return JobResult(model, det, det.found(), new_files, records, resumed)


def console_lines(spark: SparkSession, cfg: JobConfig, res: JobResult) -> Iterator[str]:
    """The alert lines for the console without rescoring the table: none-found
    comes from the statistics; file alerts are read back from the part files this
    run appended. All lines, or the first ``cfg.console_limit`` and a notice."""
    if not res.found:
        return iter([NONE_FOUND])
    if res.new_files:                     # this run's lines only (the sink appends)
        return all_lines(spark.read.text(res.new_files), cfg.console_limit)
    return all_lines(res.detection.alerts(), cfg.console_limit)


def _parse(argv: list[str] | None) -> JobConfig:
    p = argparse.ArgumentParser(prog="farpoint-job", description=__doc__.splitlines()[0])
    p.add_argument("--features", nargs="+", required=True)
    p.add_argument("--train-path")
    p.add_argument("--score-path")
    p.add_argument("--source", default="file")
    p.add_argument("--file-type", default="csv")
    p.add_argument("--brokers")
    p.add_argument("--input-topic")
    p.add_argument("--score-topic")
    p.add_argument("--value-schema")
    p.add_argument("--schema", help="DDL schema for file sources (skips CSV inference)")
    p.add_argument("--sampling-ratio", type=float, help="infer CSV types from a sample")
    p.add_argument("--algorithm", default="kMeans")
    p.add_argument("--metric", default="euclidean")
    p.add_argument("--n-sigma", type=float)
    p.add_argument("--rule", default="sigma")
    p.add_argument("--no-refit", action="store_true")
    p.add_argument("--layout", default="3n")
    p.add_argument("--id-col")
    p.add_argument("--k", type=int)
    p.add_argument("--output", default="file")
    p.add_argument("--output-path")
    p.add_argument("--output-topic")
    p.add_argument("--console-limit", type=int, help="print so many alert lines at most")
    p.add_argument("--starting-offsets")
    p.add_argument("--ending-offsets")
    p.add_argument("--bad-records-path", help="write unreadable records there as JSON lines")
    p.add_argument("--run-dir", help="folder on shared storage; start again with it to resume")
    a = p.parse_args(argv)
    return JobConfig(features=a.features, train_path=a.train_path, score_path=a.score_path,
                     source=a.source, file_type=a.file_type, brokers=a.brokers,
                     input_topic=a.input_topic, score_topic=a.score_topic,
                     value_schema=a.value_schema, schema=a.schema,
                     sampling_ratio=a.sampling_ratio, algorithm=a.algorithm, metric=a.metric,
                     n_sigma=a.n_sigma, rule=a.rule, refit=not a.no_refit, layout=a.layout,
                     id_col=a.id_col, k=a.k, output=a.output, output_path=a.output_path,
                     output_topic=a.output_topic, console_limit=a.console_limit,
                     starting_offsets=a.starting_offsets, ending_offsets=a.ending_offsets,
                     bad_records_path=a.bad_records_path, run_dir=a.run_dir)


def main(argv: list[str] | None = None) -> int:
    from ..session import build_session
    cfg = _parse(argv)
    spark = build_session()
    try:
        res = run_job(spark, cfg)
        for line in console_lines(spark, cfg, res):  # K4
            print(line)
        print(json.dumps({"k": res.model.k, "found": res.found,
                          "threshold": res.detection.threshold,
                          "records": {t: asdict(c) for t, c in res.records.items()}}))
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":  # pragma: no cover
    raise SystemExit(main())
