"""Reading with every record accounted for.

A payload or line that cannot be read does not turn into a row of nulls here. Each record
is parsed once, with its raw text kept where it does not fit; then ``rows`` holds the
readable records with the source's own columns, ``bad`` the others with their raw text,
what could be parsed of them, the reason, and for Kafka their place in the topic.
``counts`` tells how many records there are of each kind.

``rows`` carries an observation, so the job that reads it first (for row formats, the one
that stages the feature columns) counts the records on its way: no scan of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .files import file_format_by_name, read_file
from .kafka import read_kafka

BAD = "__fp_bad_record"
EMPTY, NOT_JSON, MISFIT = "empty payload", "not JSON", "does not fit the schema"


@dataclass
class Counts:
    """Records read, and how many of them are bad."""

    records: int
    bad: int

    @property
    def good(self) -> int:
        return self.records - self.bad


@dataclass
class Checked:
    """Readable records, and the others; both lazy."""

    rows: DataFrame
    bad: DataFrame
    parsed: DataFrame               # all records, with the raw text of bad ones
    observation: Observation | None = None

    def counts(self) -> Counts:
        """By one aggregate over the source."""
        row = self.parsed.agg(*_counters(self.rows.columns)).first()
        return Counts(int(row["records"]), int(row["bad"] or 0))

    def observed(self) -> Counts:
        """As counted by the first job that read ``rows``; waits for one."""
        found = self.observation.get
        return Counts(int(found["records"]), int(found["bad"] or 0))


def _counters(columns: list[str]) -> list[Column]:
    """Counts of records, and of values by column: a record is bad if any of its columns
    is, so all must be parsed, also where a query reads some of them only."""
    return [F.count(F.lit(1)).alias("records"), F.count(F.col(BAD)).alias("bad"),
            *[F.count(F.col(f"`{c}`")).alias(f"values_{i}") for i, c in enumerate(columns)]]


def _with_bad_column(schema: StructType | str) -> StructType:
    found = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return StructType([*found.fields, StructField(BAD, StringType())])


def _checked(parsed: DataFrame, columns: list[str], reason: Column,
             place: list[str]) -> Checked:
    seen = Observation()
    rows = parsed.observe(seen, *_counters(columns)).where(F.col(BAD).isNull())
    # what was parsed comes along: a scan of the raw text alone would not parse the lines
    fields = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("parsed")
    bad = parsed.where(F.col(BAD).isNotNull()).select(
        *place, F.col(BAD).alias("record"), fields, reason.alias("reason"))
    return Checked(rows.select(*[F.col(f"`{c}`") for c in columns]), bad, parsed, seen)


def _reason(record: Column) -> Column:
    """Why a JSON record is bad; JSON is looked at again for bad records only."""
    return (F.when(F.trim(record) == "", EMPTY)
            .when(F.try_parse_json(record).isNull(), NOT_JSON).otherwise(MISFIT))


def decode_checked(raw: DataFrame, schema: StructType | str) -> Checked:
    """JSON payloads of Kafka rows. A null or blank payload is a bad record, too, and
    so is a list: Spark would read its first entry and lose the others."""
    text = F.col("value").cast("string")
    full = _with_bad_column(schema)
    record = F.from_json(text, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})
    lost = text.isNull() | (F.trim(text) == "") | F.ltrim(text).startswith("[")
    columns = [f.name for f in full.fields if f.name != BAD]
    place = [c for c in ("topic", "partition", "offset") if c in raw.columns]
    named = {c: f"__fp_{c}" for c in place}
    parsed = (raw.select(*[F.col(c).alias(n) for c, n in named.items()], record.alias("r"),
                         text.alias("text"), lost.alias("lost"))
              .select(*named.values(), *[F.col(f"r.`{c}`").alias(c) for c in columns],
                      F.when(F.col("lost") | F.col("r").isNull(), F.coalesce("text", F.lit("")))
                      .otherwise(F.col(f"r.{BAD}")).alias(BAD)))
    found = _checked(parsed, columns, _reason(F.col(BAD)), list(named.values()))
    found.bad = found.bad.withColumnsRenamed({n: c for c, n in named.items()})
    return found


def read_checked(spark: SparkSession, path: str, file_type: str = "csv", *,
                 schema: StructType | str | None = None,
                 sampling_ratio: float | None = None) -> Checked:
    """CSV or JSON lines. Without a schema, types are inferred first (one more scan,
    of a share of the records with ``sampling_ratio``), bad lines left out."""
    kind = file_format_by_name(file_type)
    if kind == "parquet":
        raise ValueError("parquet has no bad records; use read_file")
    if schema is None:
        inferred = read_file(spark, path, kind, sampling_ratio=sampling_ratio).schema
        lost = spark.conf.get("spark.sql.columnNameOfCorruptRecord")
        schema = StructType([f for f in inferred.fields if f.name != lost])
    full = _with_bad_column(schema)
    reader = (spark.read.schema(full).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", BAD))
    columns = [f.name for f in full.fields if f.name != BAD]
    if kind == "json":
        return _checked(reader.json(path), columns, _reason(F.col(BAD)), [])
    return _checked(reader.option("header", "true").csv(path), columns, F.lit(MISFIT), [])


def checked_source(spark: SparkSession, kind: str = "file", *, path: str | None = None,
                   file_type: str = "csv", brokers: str | None = None, topic: str | None = None,
                   value_schema: StructType | str | None = None,
                   schema: StructType | str | None = None, sampling_ratio: float | None = None,
                   starting_offsets: str | None = None, ending_offsets: str | None = None,
                   options: dict[str, str] | None = None) -> Checked | None:
    """The checked form of ``read_source``; None for sources without records to check
    (parquet, and Kafka rows that are not decoded)."""
    if (kind or "").lower() == "file":
        if not path or file_format_by_name(file_type) == "parquet":
            return None
        return read_checked(spark, path, file_type, schema=schema, sampling_ratio=sampling_ratio)
    if (kind or "").lower() == "kafka" and value_schema is not None:
        raw = read_kafka(spark, brokers or "", topic or "", starting_offsets=starting_offsets,
                         ending_offsets=ending_offsets, options=options)
        return decode_checked(raw, value_schema)
    return None
