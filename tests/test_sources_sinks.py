"""Sources (CSV / JSON / Kafka decode / discovery / preview) and sinks."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from farpoint.functions.alerts import ALERT_PREFIX, NONE_FOUND, format_alerts
from farpoint.plans.catalogue import staged, table
from farpoint.session import scratch_path
from farpoint.sinks import console_lines, write_alerts, write_text
from farpoint.sources import (column_names, decode_kafka, preview, read_file, read_source,
                              schema_text, to_kafka_rows)


def test_csv_inference_and_header(spark):
    customer = table(spark, SF_SMALL, "customer")
    path = staged(customer, "csv")
    df = read_file(spark, path, "CSV")
    assert df.columns == customer.columns
    assert dict(df.dtypes)["c_custkey"] == "int"          # inferred from text
    assert dict(df.dtypes)["c_acctbal"] == "double"
    assert df.count() == customer.count()
    assert column_names(spark, path) == customer.columns
    src = read_source(spark, "File", path=path, file_type="csv")
    assert src.count() == customer.count()


def test_json_columns_alphabetical(spark):
    customer = table(spark, SF_SMALL, "customer")
    df = read_file(spark, staged(customer, "json"), "json")
    assert df.columns == sorted(customer.columns)


def test_bad_names_raise(spark):
    with pytest.raises(ValueError):
        read_file(spark, "/nowhere", "xml")
    with pytest.raises(ValueError):
        read_source(spark, "socket", path="/nowhere")
    df = spark.createDataFrame([("x",)], "value string")
    with pytest.raises(ValueError):
        write_alerts(df, "email", path="/nowhere")


def test_kafka_rows_decode(spark):
    events = table(spark, SF_SMALL, "events")
    raw = to_kafka_rows(events, "event_id", ["event_id", "event_type", "value"], "t")
    assert [f.name for f in raw.schema.fields] == ["key", "value", "topic", "partition",
                                                   "offset", "timestamp", "timestampType"]
    out = decode_kafka(raw, "event_id long, event_type string, value double", keep_key=True)
    got = sorted(tuple(r) for r in out.select("event_id", "event_type", "value").collect())
    want = sorted(tuple(r) for r in events.select("event_id", "event_type", "value").collect())
    assert got == want
    assert out.where(F.col("kafka_key") != F.col("event_id").cast("string")).count() == 0


def test_kafka_reader_needs_connector(spark):
    """No Kafka connector jar is on this classpath: the read fails clearly."""
    with pytest.raises(Exception, match="(?i)kafka"):
        read_source(spark, "kafka", brokers="localhost:1", topic="t").count()


def test_preview_and_schema(spark):
    events = table(spark, SF_SMALL, "events")
    rows = preview(events, 5, ["event_id"]).collect()
    assert [r["event_id"] for r in rows] == [0, 1, 2, 3, 4]
    text = schema_text(events)
    assert text.startswith("root\n |-- event_id: long")


def test_text_sink_appends(spark):
    df = spark.createDataFrame([(0, "a", 1.5), (1, None, 2.0)], "id long, s string, x double")
    alerts = format_alerts(df)
    lines = sorted(r[0] for r in alerts.collect())
    assert lines == [ALERT_PREFIX + "1: [0,a,1.5]", ALERT_PREFIX + "2: [1,null,2.0]"]
    path = scratch_path(spark, "test-alerts")
    write_text(alerts, path)
    write_alerts(alerts, "FILE", path=path)
    assert spark.read.text(path).count() == 4
    assert console_lines(alerts.where("false")) == [NONE_FOUND]


def test_kafka_sink_needs_connector(spark):
    """The Kafka sink hands the lines to Spark's Kafka writer; without the
    connector jar on the classpath it fails clearly instead of dropping them."""
    df = spark.createDataFrame([("line",)], "value string")
    with pytest.raises(Exception, match="(?i)kafka"):
        write_alerts(df, "Kafka", brokers="localhost:1", topic="alerts")
    with pytest.raises(ValueError):
        write_alerts(df, "kafka", brokers="", topic="alerts")
