"""Alert text.

Form: ``<prefix><id + 1>: [<v1>,<v2>,...]`` over every column of the scored
table in table order, values without spaces and nulls printed as ``null``.
``id + 1`` is the printed line number: ids are zero-based row ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The reference's alert wording (Russian), kept verbatim.
# "Обнаружена аномалия в строке " = "Anomaly found in line ";
# "Аномалии не обнаружены." = "No anomalies found."
ALERT_PREFIX = "Обнаружена аномалия в строке "
NONE_FOUND = "Аномалии не обнаружены."

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def resolve_id_column(df: DataFrame, id_col: str | None) -> str:
    """The id column: given, or the table's first column; must be integral."""
    name = id_col if id_col is not None else (df.columns[0] if df.columns else None)
    if name is None or name not in df.columns:
        raise ValueError(f"id column {id_col!r} not found in {df.columns}")
    dtype = df.schema[name].dataType
    if not isinstance(dtype, _INTEGRAL):
        raise ValueError(f"id column {name!r} must be an integer column, not {dtype.simpleString()}")
    return name


def value_text(column: str, dtype: T.DataType | None = None) -> Column:
    """One value as the reference prints it (Java ``toString`` forms).

    Spark's string cast matches Java for numbers, strings and booleans; a
    timestamp on a whole second gets Java's ``.0`` fraction.
    """
    text = F.col(column).cast("string")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        text = F.when(F.instr(text, ".") == 0, F.concat(text, F.lit(".0"))).otherwise(text)
    return F.coalesce(text, F.lit("null"))


def row_text(columns: list[str], types: dict[str, T.DataType] | None = None) -> Column:
    """``[v1,v2,...]`` with nulls printed as ``null`` (concat_ws alone skips nulls)."""
    types = types or {}
    vals = [value_text(c, types.get(c)) for c in columns]
    return F.concat(F.lit("["), F.concat_ws(",", *vals), F.lit("]"))


def alert_text(id_col: str, columns: list[str], prefix: str = ALERT_PREFIX,
               types: dict[str, T.DataType] | None = None) -> Column:
    """Alert line for one row as a string column."""
    known = F.when(F.col(id_col).isNull(), F.raise_error(F.lit(
        f"id column {id_col!r} is null in a flagged row"))).otherwise(F.col(id_col).cast("long"))
    line = (known + F.lit(1)).cast("string")
    return F.concat(F.lit(prefix), line, F.lit(": "), row_text(columns, types))


def format_alerts(df: DataFrame, id_col: str | None = None,
                  columns: list[str] | None = None) -> DataFrame:
    """One ``value`` string column, one alert line per row of ``df``."""
    cols = list(columns) if columns is not None else list(df.columns)
    name = resolve_id_column(df.select(*cols), id_col)
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(alert_text(name, cols, types=types).alias("value"))
