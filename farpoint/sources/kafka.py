"""Kafka input.

``read_kafka`` is one bounded batch read of a topic, as in the reference; it
needs Spark's Kafka connector on the classpath. The raw rows carry the
payload in ``value`` (binary), so ``decode_kafka`` parses it (JSON) into
columns before features can be chosen - the step the reference lacks.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Spark's Kafka source schema (fixed by the connector).
KAFKA_SCHEMA = ("key binary, value binary, topic string, partition int, offset long, "
                "timestamp timestamp, timestampType int")


def read_kafka(spark: SparkSession, brokers: str, topic: str, *,
               starting_offsets: str | None = None,
               ending_offsets: str | None = None,
               options: dict[str, str] | None = None) -> DataFrame:
    """Bounded batch read of ``topic``."""
    if not brokers or not topic:
        raise ValueError("Kafka brokers and topic are required")
    reader = (spark.read.format("kafka")
              .option("kafka.bootstrap.servers", brokers)
              .option("subscribe", topic))
    if starting_offsets:
        reader = reader.option("startingOffsets", starting_offsets)
    if ending_offsets:
        reader = reader.option("endingOffsets", ending_offsets)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load()


def pinned_offsets(raw: DataFrame) -> str | None:
    """The ``endingOffsets`` JSON that fixes a topic read at the records it has now.

    One row per topic partition reaches the driver. None if there are no records.
    """
    ends = raw.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end")).collect()
    out: dict[str, dict[str, int]] = {}
    for r in ends:
        out.setdefault(r["topic"], {})[str(r["partition"])] = r["end"]
    return json.dumps(out, sort_keys=True) if out else None


def plan_offsets(ends: dict[str, dict[int, int]]) -> str:
    """The offsets JSON that Spark's reader takes, from {topic: {partition: end}}.

    The reader wants every partition of a topic in it, those without records as well.
    """
    return json.dumps({topic: {str(p): int(end) for p, end in sorted(parts.items())}
                       for topic, parts in sorted(ends.items())})


def topic_ends(spark: SparkSession, brokers: str, topic: str,
               options: dict[str, str] | None = None) -> dict[str, dict[int, int]]:
    """End offset of every partition of ``topic``, empty ones too, from the brokers'
    metadata: no record is read. Needs the Kafka client that comes with the connector."""
    jvm = spark.sparkContext._jvm
    kafka = jvm.org.apache.kafka
    settings = jvm.java.util.Properties()
    settings.put("bootstrap.servers", brokers)
    for side in ("key", "value"):
        settings.put(f"{side}.deserializer",
                     "org.apache.kafka.common.serialization.ByteArrayDeserializer")
    for key, value in (options or {}).items():
        if key.startswith("kafka."):
            settings.put(key.removeprefix("kafka."), value)
    consumer = kafka.clients.consumer.KafkaConsumer(settings)
    try:
        parts = jvm.java.util.ArrayList()
        for info in consumer.partitionsFor(topic):
            parts.add(kafka.common.TopicPartition(topic, info.partition()))
        found = consumer.endOffsets(parts)
        return {topic: {p.partition(): found.get(p) for p in parts}}
    finally:
        consumer.close()


def decode_kafka(df: DataFrame, schema: StructType | str, *, keep_key: bool = False) -> DataFrame:
    """Parse the JSON payload in ``value`` into top-level columns."""
    parsed = F.from_json(F.col("value").cast("string"), schema).alias("r")
    cols: list[Column | str] = [parsed]
    if keep_key:
        cols.insert(0, F.col("key").cast("string").alias("kafka_key"))
    out = df.select(*cols)
    return out.select(*(["kafka_key"] if keep_key else []), "r.*")


def to_kafka_rows(df: DataFrame, key_col: str | None, value_cols: list[str],
                  topic: str) -> DataFrame:
    """Rows in the Kafka source schema with a JSON payload of ``value_cols``.

    Gives a table the shape a batch read of a topic returns (offsets are
    row numbers within each Spark partition plus a partition base); used to
    exercise the decoder without a broker.
    """
    key = (F.col(key_col).cast("string").cast("binary") if key_col
           else F.lit(None).cast("binary"))
    return df.select(
        key.alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in value_cols])).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.spark_partition_id().alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
