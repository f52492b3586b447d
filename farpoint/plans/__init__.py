"""Composite plans: train, detect, the end-to-end job and the query catalogue."""
from .model import AnomalyModel, Detection, train

__all__ = ["AnomalyModel", "Detection", "train"]
