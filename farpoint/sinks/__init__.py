"""Sinks for alert lines (K1-K4).

Alerts are a one-column ``value`` DataFrame. The file sink appends part
files to a directory, written by the executors in parallel (the reference
appends lines to one local file from the driver); with a commit id, a replay
leaves the directory as it is. The Kafka sink sends one message per line with
no key. Write errors propagate.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame

from ..functions.alerts import NONE_FOUND
from .commit import commit_text, committed_lines, is_committed

__all__ = ["SINK_KINDS", "all_lines", "commit_text", "committed_lines", "console_lines",
           "is_committed", "write_alerts", "write_kafka", "write_text"]

SINK_KINDS = ("file", "kafka")


def _value_only(alerts: DataFrame) -> DataFrame:
    if "value" not in alerts.columns:
        raise ValueError("alerts need a 'value' column; use format_alerts first")
    return alerts.select("value")


def write_text(alerts: DataFrame, path: str, mode: str = "append") -> None:
    """K1: append the lines as text part files under ``path``."""
    _value_only(alerts).write.mode(mode).text(path)


def write_kafka(alerts: DataFrame, brokers: str, topic: str) -> None:
    """K2: one message per line, value only."""
    if not brokers or not topic:
        raise ValueError("Kafka brokers and topic are required")
    (_value_only(alerts).write.format("kafka")
     .option("kafka.bootstrap.servers", brokers).option("topic", topic).save())


def write_alerts(alerts: DataFrame, kind: str = "file", *, path: str | None = None,
                 brokers: str | None = None, topic: str | None = None,
                 commit: str | None = None) -> None:
    """K3: choose the sink by name (case-insensitive).

    With a ``commit`` id the file sink writes these lines once, however often it is
    called with that id (``commit_text``). Kafka has no such log: a replay sends again.
    """
    key = (kind or "").lower()
    if key == "file":
        if not path:
            raise ValueError("a file sink needs a path")
        if commit is None:
            write_text(alerts, path)
        else:
            commit_text(_value_only(alerts), path, commit)
    elif key == "kafka":
        write_kafka(alerts, brokers or "", topic or "")
    else:
        raise ValueError(f"unsupported output type {kind!r}; expected one of {SINK_KINDS}")


def console_lines(alerts: DataFrame, n: int = 20) -> list[str]:
    """K4: the first ``n`` lines and a notice if there are more, or the none-found message."""
    return list(all_lines(alerts, n))


def all_lines(alerts: DataFrame, n: int | None = None) -> Iterator[str]:
    """K4: every line for printing, or the none-found message.

    Rows come partition by partition, so the driver never holds them all. With
    ``n``, that many lines and a notice if there are more.
    """
    values = _value_only(alerts)
    shown = 0
    rows = values.toLocalIterator() if n is None else iter(values.take(n + 1))
    for row in rows:
        if shown == n:
            yield f"... more lines follow; only the first {n} are shown"
            return
        shown += 1
        yield row["value"]
    if not shown:
        yield NONE_FOUND
