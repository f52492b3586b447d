"""Every record is read or reported as bad, from Kafka payloads, CSV and JSON lines."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import MALL_FEATURES, mall_rows
from farpoint.plans.catalogue import staged
from farpoint.plans.job import JobConfig, run_job
from farpoint.session import scratch_path
from farpoint.sources import checked_source, decode_checked, read_checked, read_json
from farpoint.sources.checked import EMPTY, MISFIT, NOT_JSON, Counts

SCHEMA = "id long, s string, x double"
PAYLOADS = [('{"id": 1, "s": "a", "x": 1.5}', None), ('{"id": 2}', None), ("{}", None),
            ('{"id": 3, "s": "b", "x": 2, "more": [1]}', None), ("not json", NOT_JSON),
            ('{"id": 4, "s": "c"', NOT_JSON), ("", EMPTY), ("  ", EMPTY), (None, EMPTY),
            ('{"id": "five", "s": "d", "x": 1}', MISFIT), ("[]", MISFIT), ("17", MISFIT),
            ('[{"id": 6}, {"id": 7}]', MISFIT), ("null", MISFIT),
            ('{"id": 8, "s": {"deep": 1}, "x": 0}', None)]


def kafka_rows(spark, payloads):
    rows = [(None if p is None else bytearray(p.encode()), "t", i % 2, i)
            for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "value binary, topic string, partition int, offset long")


def test_no_payload_disappears(spark):
    found = decode_checked(kafka_rows(spark, [p for p, _ in PAYLOADS]), SCHEMA)
    bad = {r["offset"]: r for r in found.bad.collect()}
    assert {i: r["reason"] for i, r in bad.items()} == {
        i: why for i, (_, why) in enumerate(PAYLOADS) if why}
    assert all(r["record"] == (PAYLOADS[i][0] or "") for i, r in bad.items())
    assert bad[9]["partition"] == 1 and bad[9]["topic"] == "t"
    assert json.loads(bad[9]["parsed"])["s"] == "d"          # what could be read of it
    rows = found.rows.collect()
    assert found.rows.columns == ["id", "s", "x"]
    assert sorted(r["id"] for r in rows if r["id"] is not None) == [1, 2, 3, 8]
    assert len(rows) + len(bad) == len(PAYLOADS)
    assert found.counts() == found.observed() == Counts(len(PAYLOADS), len(bad))


def test_clashing_names_and_no_rows(spark):
    schema = "offset string, topic string, r string, text string, lost int"
    found = decode_checked(kafka_rows(spark, ['{"offset": "o", "r": "x", "lost": 3}', "bad"]),
                           schema)
    row = found.rows.first()
    assert (row["offset"], row["topic"], row["r"], row["lost"]) == ("o", None, "x", 3)
    assert [r["offset"] for r in found.bad.collect()] == [1]
    empty = decode_checked(kafka_rows(spark, []), SCHEMA)
    assert empty.rows.count() == 0 and empty.counts() == Counts(0, 0)


def written(spark, lines, name):
    path = scratch_path(spark, name)
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


def test_json_lines(spark):
    path = written(spark, ['{"id": 1, "x": 0.5}', "oops", '{"id": "two", "x": 1}', '{"id": 3}'],
                   "bad-json")
    found = read_checked(spark, path, "json", schema="id long, x double")
    # a bad value is seen also by a query that does not read its column
    assert found.rows.select("x").count() == 2
    assert sorted(r["id"] for r in found.rows.collect()) == [1, 3]
    assert sorted((r["record"], r["reason"]) for r in found.bad.collect()) == [
        ("oops", NOT_JSON), ('{"id": "two", "x": 1}', MISFIT)]
    assert found.observed() == Counts(4, 2)
    inferred = read_checked(spark, path, "json")
    assert inferred.rows.columns == ["id", "x"] and inferred.counts() == Counts(4, 1)


def test_csv_lines(spark):
    path = written(spark, ["id,s,x", "1,a,0.5", "2,b", "3,c,much", "4,d,1.5,more", "5,,"],
                   "bad-csv")
    found = read_checked(spark, path, "csv", schema=SCHEMA)
    assert sorted(r["id"] for r in found.rows.collect()) == [1, 5]
    assert sorted(r["record"] for r in found.bad.collect()) == ["2,b", "3,c,much", "4,d,1.5,more"]
    # columns read alone see the same bad lines
    assert sorted(r[0] for r in found.rows.select("id").collect()) == [1, 5]
    assert found.counts() == Counts(5, 3)


def test_sources_without_records_to_check(spark):
    assert checked_source(spark, "file", path="/nowhere", file_type="parquet") is None
    assert checked_source(spark, "kafka", brokers="b", topic="t") is None
    with pytest.raises(ValueError):
        read_checked(spark, "/nowhere", "parquet")


def test_json_sampling_ratio_reaches_the_reader(spark):
    rows = [json.dumps({"a": 1})] * 2000 + [json.dumps({"a": 1, "late": 2})]
    path = written(spark, rows, "sampled-json")
    assert read_json(spark, path).columns == ["a", "late"]
    assert read_json(spark, path, sampling_ratio=0.001).columns == ["a"]


def test_job_counts_and_writes_bad_records(spark, mall):
    clean, _ = mall
    lines = ["id,Genre,Age,AnnualIncome,SpendingScore"] + [
        ",".join(map(str, r)) for r in mall_rows(True)]
    lines[3:3] = ["nonsense", "900,Female,old,20,30"]
    out, bad = scratch_path(spark, "job-alerts"), scratch_path(spark, "job-bad")
    res = run_job(spark, JobConfig(
        features=MALL_FEATURES, train_path=staged(clean, "csv"),
        score_path=written(spark, lines, "score-csv"), output_path=out, bad_records_path=bad,
        schema="id int, Genre string, Age int, AnnualIncome int, SpendingScore int"))
    assert res.records == {"train": Counts(200, 0), "score": Counts(202, 2)}
    assert sorted(r["id"] for r in res.detection.flagged.collect()) == [50, 72]
    found = [json.loads(r[0]) for r in spark.read.text(bad).collect()]
    assert sorted(f["record"] for f in found) == ["900,Female,old,20,30", "nonsense"]
    assert {f["table"] for f in found} == {"score"}


def test_bad_records_leave_the_observation_to_the_first_job(spark):
    found = decode_checked(kafka_rows(spark, ['{"id": 1}', "x"]), SCHEMA)
    narrow = found.rows.select("id").where(F.col("id") > 0)
    assert narrow.count() == 1
    assert found.observed() == Counts(2, 1)
