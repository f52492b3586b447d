"""File scans.

CSV is read with a header and, like the reference, with type inference.
Inference costs one extra pass over the file; on large inputs pass a
``schema`` (or a ``sampling_ratio``) to avoid it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Accepted file formats (case-insensitive). The reference implements csv and
# offers json in its picker; parquet is the format of the driver tables.
FILE_FORMATS = ("csv", "json", "parquet")


def file_format_by_name(name: str) -> str:
    key = (name or "").lower()
    if key not in FILE_FORMATS:
        raise ValueError(f"unsupported file type {name!r}; expected one of {FILE_FORMATS}")
    return key


def read_csv(spark: SparkSession, path: str, *, schema: StructType | str | None = None,
             sampling_ratio: float | None = None) -> DataFrame:
    """CSV with a header row; types inferred unless a schema is given."""
    reader = spark.read.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
        if sampling_ratio is not None:
            reader = reader.option("samplingRatio", str(sampling_ratio))
    return reader.csv(path)


def read_json(spark: SparkSession, path: str, *,
              schema: StructType | str | None = None,
              sampling_ratio: float | None = None) -> DataFrame:
    """JSON lines (S3). Inferred columns come out in alphabetical order."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    elif sampling_ratio is not None:
        reader = reader.option("samplingRatio", str(sampling_ratio))
    return reader.json(path)


def read_file(spark: SparkSession, path: str, file_type: str = "csv", *,
              schema: StructType | str | None = None,
              sampling_ratio: float | None = None) -> DataFrame:
    """Read a file by type name (S2). For CSV and JSON, ``schema`` skips inference and
    ``sampling_ratio`` infers from a sample instead of a full extra pass."""
    kind = file_format_by_name(file_type)
    if kind == "csv":
        return read_csv(spark, path, schema=schema, sampling_ratio=sampling_ratio)
    if kind == "json":
        return read_json(spark, path, schema=schema, sampling_ratio=sampling_ratio)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def column_names(spark: SparkSession, path: str, file_type: str = "csv") -> list[str]:
    """Column names for a feature picker (S7): CSV header only, no inference."""
    kind = file_format_by_name(file_type)
    if kind == "csv":
        return spark.read.option("header", "true").csv(path).columns
    return read_file(spark, path, kind).columns


def column_frame(spark: SparkSession, names: list[str]) -> DataFrame:
    """Column names as a (position, column_name) table."""
    return spark.createDataFrame(list(enumerate(names)), "position int, column_name string")


def preview(df: DataFrame, n: int = 20, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows (S8); with ``order_by`` the rows are well defined.

    A top-n, so Spark plans it as TakeOrderedAndProject: each task keeps n
    rows and only those are merged.
    """
    if order_by:
        df = df.orderBy(*[F.col(c) for c in order_by])
    return df.limit(n)


def schema_text(df: DataFrame) -> str:
    """The schema exactly as ``printSchema`` prints it."""
    return df.schema.treeString()
