"""Sources: CSV / JSON / Parquet files and Kafka (batch)."""
from .checked import Checked, checked_source, decode_checked, read_checked
from .files import (FILE_FORMATS, column_frame, column_names, preview, read_csv, read_file,
                    read_json, schema_text)
from .kafka import KAFKA_SCHEMA, decode_kafka, read_kafka, to_kafka_rows
from .select import read_source

__all__ = ["Checked", "FILE_FORMATS", "KAFKA_SCHEMA", "checked_source", "column_frame",
           "column_names", "decode_checked", "decode_kafka", "preview", "read_checked", "read_csv",
           "read_file", "read_json", "read_kafka", "read_source", "schema_text", "to_kafka_rows"]
