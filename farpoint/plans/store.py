"""Saved models (E1, F6): a fitted model in a folder of the shared store.

A version is a folder ``v-<n>`` with ``model.json`` (algorithm, centres, preparation, the
small label mappings) and one Parquet table for each larger label mapping. It is written
under a draft name and published by a rename, so a reader never finds half a model and a
version never changes. Numbers are written so that they read back to the last bit: a model
loaded in another session scores a table like the one that was saved.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from .. import storage
from ..operators.detection import DistanceStats
from ..operators.features import FeatureModel
from ..operators.indexing import LabelTable
from .model import AnomalyModel

FORMAT = 1


def versions(spark: SparkSession, path: str) -> list[int]:
    """Published versions under ``path``, in order."""
    found = [n.removeprefix("v-") for n in storage.names(spark, path) if n.startswith("v-")]
    return sorted(int(n) for n in found if n.isdigit())


def _label_entry(table: LabelTable) -> dict:
    return {"column": table.column, "label_col": table.label_col, "index_col": table.index_col,
            "size": table.size, "local": table.local, "mean": table.mean, "std": table.std,
            "mapping": table.mapping}


def save_model(spark: SparkSession, model: AnomalyModel, path: str) -> int:
    """Publish ``model`` as the next version under ``path``; its number."""
    path = path.rstrip("/")
    draft = f"{path}/_draft-{uuid.uuid4().hex}"
    prep = model.preparation
    for i, table in enumerate(prep.labels):
        if table.mapping is None:
            table.frame.write.parquet(f"{draft}/labels-{i}")
    storage.write_json(spark, f"{draft}/model.json", {
        "format": FORMAT, "algorithm": model.algorithm, "features": model.features,
        "centres": model.centres, "k": model.k, "seed": model.seed,
        "silhouettes": sorted(model.silhouettes.items()),
        "spread": {m: [s.count, s.mean, s.std, s.max] for m, s in model.spread.items()},
        "preparation": {"numeric": prep.numeric, "strings": prep.strings, "stds": prep.stds,
                        "rows_seen": prep.rows_seen, "rows_kept": prep.rows_kept,
                        "layout": prep.layout,
                        "labels": [_label_entry(t) for t in prep.labels]}})
    number = max(versions(spark, path), default=0) + 1
    while not storage.rename(spark, draft, f"{path}/v-{number}"):
        number += 1             # another writer published this number
    return number


def load_model(spark: SparkSession, path: str, version: int | None = None) -> AnomalyModel:
    """The given version, or the latest one. It scores tables; MLlib's model is not kept."""
    path = path.rstrip("/")
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        raise ValueError(f"no saved model {'' if version is None else f'v-{version} '}in {path}")
    at = f"{path}/v-{known[-1] if version is None else version}"
    found = storage.read_json(spark, f"{at}/model.json")
    if found["format"] != FORMAT:
        raise ValueError(f"{at} has format {found['format']}, expected {FORMAT}")
    prep = found["preparation"]
    labels = [LabelTable(frame=None if entry["mapping"] is not None
                         else spark.read.parquet(f"{at}/labels-{i}"), **entry)
              for i, entry in enumerate(prep.pop("labels"))]
    preparation = FeatureModel(features=found["features"], labels=labels, **prep)
    return AnomalyModel(found["algorithm"], found["features"], found["centres"], preparation,
                        found["k"], found["seed"], dict(map(tuple, found["silhouettes"])),
                        spread={m: DistanceStats(*s) for m, s in found["spread"].items()})
