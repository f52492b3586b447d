"""Clustering (C1-C7): MLlib k-means / bisecting k-means and the k search.

The search fits k = k_min..k_max (3..10 by default) with seed 1 and keeps the
first k whose silhouette is strictly larger than the best so far, starting
from 0 (so a search with no positive silhouette finds nothing and raises).
The winning search model is kept; there is no ninth refit, which would give
the same model for the same data, seed and k.

The fits read one written frame holding only the coordinate vector. Fits for
different k are independent jobs, so on small tables they run from a few
driver threads at once (``parallelism``); the winner is chosen in k order
afterwards, so the result does not depend on it. Bisecting fits of all k share their
passes instead (``bisecting``).

All models are scored together (``silhouettes``): one scan gathers the cluster sums of
every k, a second one the mean silhouettes of every k, in place of two scans for each k.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .bisecting import fit_bisecting

# Fixed values from the reference: k range, seed, algorithm names.
K_MIN = 3
K_MAX = 10
SEED = 1
ALGORITHMS = {"kmeans": KMeans, "bisectingkmeans": BisectingKMeans}


def algorithm_by_name(name: str) -> str:
    """Normalise an algorithm name (case-insensitive ``kMeans`` /
    ``bisectingKMeans``); unknown names raise ``ValueError``."""
    key = (name or "").replace("_", "").replace("-", "").lower()
    if key not in ALGORITHMS:
        raise ValueError(f"unsupported clustering algorithm {name!r}; "
                         "expected 'kMeans' or 'bisectingKMeans'")
    return key


def estimator(algorithm: str, k: int, seed: int = SEED, features_col: str = "features",
              prediction_col: str = "prediction"):
    cls = ALGORITHMS[algorithm_by_name(algorithm)]
    if k < 2:
        raise ValueError(f"k must be at least 2, got {k}")
    return cls(k=k, seed=seed, featuresCol=features_col, predictionCol=prediction_col)


def fit(frame: DataFrame, algorithm: str, k: int, seed: int = SEED,
        features_col: str = "features"):
    """Fit one model."""
    return estimator(algorithm, k, seed, features_col).fit(frame)


def assign(model, frame: DataFrame, prediction_col: str = "prediction") -> DataFrame:
    """Cluster assignment."""
    return model.setPredictionCol(prediction_col).transform(frame)


def silhouette(predictions: DataFrame, features_col: str = "features",
               prediction_col: str = "prediction") -> float:
    """Mean silhouette with squared Euclidean distance."""
    evaluator = ClusteringEvaluator(featuresCol=features_col, predictionCol=prediction_col,
                                    metricName="silhouette",
                                    distanceMeasure="squaredEuclidean")
    try:
        return float(evaluator.evaluate(predictions))
    except Exception as exc:  # the evaluator asserts on a single cluster
        if "greater than one" in str(exc):
            raise ValueError("all rows fell into one cluster; the data has too few "
                             "distinct points to choose k") from exc
        raise


def cluster_sums(frame: DataFrame, clusters: dict[int, str], dimension: int) -> DataFrame:
    """One row per (k, cluster): n, sum of squared norms q, and sum y{i} of coordinate i.

    ``frame`` holds the coordinates as an array ``x``, their squared norm ``n2``, and
    for every k its cluster in column ``clusters[k]``. One aggregate over one scan; its
    partial sums are one row per task for each of the clusters of all k.
    """
    each = ", ".join(f"struct({k} as k, cast(`{c}` as int) as c)" for k, c in clusters.items())
    return (frame.selectExpr("x", "n2", f"inline(array({each}))").groupBy("k", "c")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("n2").alias("q"),
                 *[F.expr(f"sum(x[{i}]) as y{i}") for i in range(dimension)]))


def silhouettes(frame: DataFrame, clusters: dict[int, str], dimension: int,
                features_col: str = "features") -> dict[int, float]:
    """Mean silhouette (squared Euclidean) of several clusterings of the same rows.

    ``clusters`` names each k's cluster column. Two scans whatever the number of
    clusterings: the sums of all clusters, then every row's silhouettes. The mean squared
    distance of a row to a cluster follows from the cluster's sums, as in MLlib's
    evaluator, so no row is compared with another one. Only one row for each cluster
    reaches the driver. A lone row of a cluster counts 0; one cluster is an error.
    """
    x = frame.select(vector_to_array(features_col).alias("x"), *clusters.values())
    norm = " + ".join(f"x[{i}] * x[{i}]" for i in range(dimension))
    rows = x.selectExpr("*", f"{norm} as n2")
    sums: dict[int, dict[int, Row]] = {k: {} for k in clusters}
    for row in cluster_sums(rows, clusters, dimension).collect():
        sums[row["k"]][row["c"]] = row
    distances, scores = [], []
    for k, column in clusters.items():
        if len(sums[k]) < 2:
            raise ValueError("all rows fell into one cluster; the data has too few "
                             "distinct points to choose k")
        for c, s in sums[k].items():
            dot = " + ".join(f"x[{i}] * {float(s[f'y{i}'])!r}D" for i in range(dimension))
            distances.append(f"n2 + {s['q'] / s['n']!r}D - 2 * ({dot}) / {float(s['n'])!r}D "
                             f"as d_{k}_{c}")
        own = " ".join(f"when {c} then " + (f"d_{k}_{c} * {s['n'] / (s['n'] - 1)!r}D"
                                            if s["n"] > 1 else "null")
                       for c, s in sums[k].items())
        other = ", ".join(f"if(`{column}` = {c}, null, d_{k}_{c})" for c in sums[k])
        scores += [f"case cast(`{column}` as int) {own} end as a_{k}", f"least({other}) as b_{k}"]
    each = rows.selectExpr(*[f"`{c}`" for c in clusters.values()], *distances).selectExpr(*scores)
    means = [F.expr(f"avg(case when a_{k} < b_{k} then 1 - a_{k} / b_{k} "
                    f"when a_{k} > b_{k} then b_{k} / a_{k} - 1 else 0D end) as s_{k}")
             for k in clusters]
    found = each.agg(*means).first()
    return {k: float(found[f"s_{k}"]) for k in clusters}


@dataclass
class SearchResult:
    k: int
    model: object
    scores: dict[int, float]


def search_k(frame: DataFrame, algorithm: str, k_min: int = K_MIN, k_max: int = K_MAX,
             seed: int = SEED, features_col: str = "features",
             parallelism: int | None = None) -> SearchResult:
    """Choose k by silhouette (C6) on an already prepared vector frame."""
    algo = algorithm_by_name(algorithm)
    if k_min < 2 or k_max < k_min:
        raise ValueError(f"bad k range {k_min}..{k_max}")
    ks = list(range(k_min, k_max + 1))

    def run(k: int):
        return fit(frame, algo, k, seed, features_col)

    if parallelism is None:
        parallelism = 1
    parallelism = min(parallelism, len(ks))
    if algo == "bisectingkmeans":
        shared = fit_bisecting(frame, ks, seed, features_col)
        models = [shared[k] for k in ks]
    elif parallelism > 1:
        # Threads inherit the caller's local properties (job group, pool),
        # so cancelling the caller's job group also cancels the search fits.
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            models = list(pool.map(inheritable_thread_target(frame.sparkSession)(run), ks))
    else:
        models = [run(k) for k in ks]

    clusters = {k: f"cluster_{k}" for k in ks}
    assigned = frame.select(features_col)
    for k, model in zip(ks, models, strict=True):
        assigned = model.copy({model.predictionCol: clusters[k]}).transform(assigned)
    scores = silhouettes(assigned, clusters, len(models[0].clusterCenters()[0]), features_col)
    best_k, best_model, best = 0, None, 0.0
    for k, model in zip(ks, models, strict=True):
        if scores[k] > best:
            best_k, best_model, best = k, model, scores[k]
    if best_model is None:
        raise ValueError(f"no k in {k_min}..{k_max} gave a positive silhouette")
    return SearchResult(best_k, best_model, scores)


# Concurrent search fits each hold their own persisted copy of the training
# points (about 8 bytes per coordinate plus ~96 bytes of object overhead per
# row). They run at once only while all copies fit this budget; a large
# table runs one fit at a time, which already fills the cluster.
PARALLEL_SEARCH_BUDGET_BYTES = 2 * 1024 ** 3


def default_search_parallelism(rows: int, dimension: int, fits: int = K_MAX - K_MIN + 1) -> int:
    per_copy = max(1, rows) * (8 * max(1, dimension) + 96)
    return int(max(1, min(fits, PARALLEL_SEARCH_BUDGET_BYTES // per_copy)))
