"""Source choice (S6): one entry point for files and Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .files import read_file
from .kafka import decode_kafka, read_kafka

SOURCE_KINDS = ("file", "kafka")


def read_source(spark: SparkSession, kind: str = "file", *, path: str | None = None,
                file_type: str = "csv", brokers: str | None = None, topic: str | None = None,
                value_schema: StructType | str | None = None,
                schema: StructType | str | None = None,
                sampling_ratio: float | None = None, starting_offsets: str | None = None,
                ending_offsets: str | None = None,
                options: dict[str, str] | None = None) -> DataFrame:
    """``file`` → a file scan of ``file_type``; ``kafka`` → a batch topic read,
    decoded with ``value_schema`` when given. Other kinds raise."""
    key = (kind or "").lower()
    if key == "file":
        if not path:
            raise ValueError("a file source needs a path")
        return read_file(spark, path, file_type, schema=schema, sampling_ratio=sampling_ratio)
    if key == "kafka":
        raw = read_kafka(spark, brokers or "", topic or "", starting_offsets=starting_offsets,
                         ending_offsets=ending_offsets, options=options)
        return decode_kafka(raw, value_schema) if value_schema is not None else raw
    raise ValueError(f"unsupported source type {kind!r}; expected one of {SOURCE_KINDS}")
