"""Column-expression builders: distances and alert text."""
from .alerts import ALERT_PREFIX, NONE_FOUND, alert_text, format_alerts, row_text
from .distance import (METRICS, manhattan, metric_by_name, nearest_centre,
                       nearest_distance, squared_euclidean)

__all__ = ["ALERT_PREFIX", "NONE_FOUND", "alert_text", "format_alerts", "row_text",
           "METRICS", "manhattan", "metric_by_name", "nearest_centre", "nearest_distance",
           "squared_euclidean"]
