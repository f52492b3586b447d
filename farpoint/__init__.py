"""farpoint: clustering-based anomaly detection on Spark DataFrames.

Read a training table, turn chosen numeric and string columns into
coordinates, choose k by silhouette, fit k-means or bisecting k-means, then
flag rows of a second table whose distance to the nearest centre exceeds the
mean plus n standard deviations of all such distances.
"""
from .operators.features import FeatureModel, fit_features, split_features, string_columns
from .plans.model import AnomalyModel, Detection, train
from .session import build_session

__all__ = ["AnomalyModel", "Detection", "FeatureModel", "build_session", "fit_features",
           "split_features", "string_columns", "train"]
