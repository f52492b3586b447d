"""Bisecting k-means for several k at once (C2, C6), in passes that all k share.

A fit splits clusters level by level, with 20 rounds of two-means for the clusters of a
level. For one seed the fits of all k are alike up to the level at which a k needs fewer
splits than there are clusters; there it splits the largest ones. So the levels are made
once, each round as one aggregate over the rows: all clusters of the level for those k
that need them, and next to them the largest ones, as many as any other k takes.

Seed, starting centres, rounds, sizes and numbering follow MLlib's ``BisectingKMeans``
with its defaults, and so do the centres, up to the rounding of sums.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..session import default_parallelism

ROUNDS = 20            # MLlib's maxIter
MIN_COST = 2.0 ** -52  # a row; a cluster of less is one point
ROOT = 1               # the halves of cluster i are 2 * i and 2 * i + 1
Halves = dict[int, dict[int, list[float]]]


def place(splits: Halves, x: list[str], names: dict[int, object], node: int = ROOT) -> str:
    """SQL: the name of the leaf that a row falls into, null for leaves without one.

    A row goes to the half whose centre is nearest, to the first one on ties.
    """
    if node not in splits:
        return str(names.get(node, "null"))
    centres = splits[node]
    if len(centres) == 1:
        return place(splits, x, names, next(iter(centres)))
    left, right = centres[2 * node], centres[2 * node + 1]
    beyond = " + ".join(f"({c} - {(a + b) / 2!r}D) * {b - a!r}D"
                        for c, a, b in zip(x, left, right, strict=True))
    return (f"if({beyond} > 0, {place(splits, x, names, 2 * node + 1)}, "
            f"{place(splits, x, names, 2 * node)})")


@dataclass(frozen=True)
class BisectedModel:
    """A tree of splits; clusters are its leaves from left to right, as in MLlib."""

    splits: Halves
    root: list[float]
    featuresCol: str = "features"
    predictionCol: str = "prediction"

    def leaves(self, node: int = ROOT) -> list[int]:
        if node not in self.splits:
            return [node]
        return [leaf for half in sorted(self.splits[node]) for leaf in self.leaves(half)]

    def clusterCenters(self) -> list[list[float]]:
        return [self.splits[i // 2][i] if i > ROOT else self.root for i in self.leaves()]

    def copy(self, extra: dict[str, str]) -> BisectedModel:
        return replace(self, predictionCol=extra.get(self.predictionCol, self.predictionCol))

    def setPredictionCol(self, name: str) -> BisectedModel:
        return replace(self, predictionCol=name)

    def transform(self, frame: DataFrame) -> DataFrame:
        x = [f"__x[{i}]" for i in range(len(self.root))]
        names = {leaf: i for i, leaf in enumerate(self.leaves())}
        return frame.withColumn("__x", vector_to_array(self.featuresCol)).withColumn(
            self.predictionCol, F.expr(place(self.splits, x, names))).drop("__x")


def sums(rows: DataFrame, clusters: dict[str, str], x: list[str]) -> dict[str, dict[int, Row]]:
    """By clustering and cluster: n, sum of squared norms q, and the sum of each coordinate.

    ``clusters`` are SQL; rows for which one is null don't count there. One row for each
    cluster reaches the driver.
    """
    each = ", ".join(f"struct('{v}' as v, {c} as c)" for v, c in clusters.items())
    found = (rows.selectExpr(*x, "n2", f"inline(array({each}))").where("c is not null")
             .groupBy("v", "c").agg(F.count(F.lit(1)).alias("n"), F.sum("n2").alias("q"),
                                    *[F.sum(c).alias(c) for c in x]).collect())
    out: dict[str, dict[int, Row]] = {v: {} for v in clusters}
    for row in found:
        out[row["v"]][row["c"]] = row
    return out


def mean(row: Row, x: list[str]) -> list[float]:
    return [row[c] / row["n"] for c in x]


def cost(row: Row, x: list[str]) -> float:
    return max(0.0, row["q"] - row["n"] * math.fsum(m * m for m in mean(row, x)))


def first_halves(nodes: list[int], centres: dict[int, list[float]], noise: list[float]) -> Halves:
    """The centre of each cluster moved a little to both sides, by its share of ``noise``."""
    out: Halves = {}
    for at, node in enumerate(nodes):
        centre = centres[node]
        step = 1e-4 * sum(c * c for c in centre) ** 0.5
        moves = [step * u for u in noise[at * len(centre):(at + 1) * len(centre)]]
        out[node] = {2 * node: [c - m for c, m in zip(centre, moves, strict=True)],
                     2 * node + 1: [c + m for c, m in zip(centre, moves, strict=True)]}
    return out


def uniform(spark: SparkSession, seed: int, n: int) -> list[float]:
    random = spark.sparkContext._jvm.java.util.Random(seed)
    return [random.nextDouble() for _ in range(n)]


def fit_bisecting(frame: DataFrame, ks: list[int], seed: int,
                  features_col: str = "features") -> dict[int, BisectedModel]:
    """One model for each of ``ks``."""
    spark = frame.sparkSession
    split = frame.rdd.getNumPartitions()
    dimension = len(frame.select(features_col).first()[0])
    x = [f"x{i}" for i in range(dimension)]
    # dealt evenly: how the input's files are split decides nothing here
    rows = (frame.select(vector_to_array(features_col).alias("x"))
            .selectExpr(*[f"x[{i}] as x{i}" for i in range(dimension)])
            .repartition(max(split, 2 * default_parallelism(spark)))
            .selectExpr("*", " + ".join(f"{c} * {c}" for c in x) + " as n2").persist())
    try:
        return _fit(rows, x, sorted(ks), seed, split, features_col)
    finally:
        rows.unpersist()


def _fit(rows: DataFrame, x: list[str], ks: list[int], seed: int, split: int,
         features_col: str) -> dict[int, BisectedModel]:
    # clusters in the order in which MLlib meets them: as their numbers are dealt over tasks
    tasks = int(rows.sparkSession.conf.get("spark.default.parallelism", None) or split)
    clusters = sums(rows, {"all": str(ROOT)}, x)["all"]
    root = mean(clusters[ROOT], x)
    if not all(map(math.isfinite, root)):
        raise ValueError("a coordinate of a training row is NaN or infinite")
    needed = {k: k - 1 for k in ks}
    done: dict[int, BisectedModel] = {}
    tree: Halves = {}
    drawn = 0
    while needed:
        nodes = [i for i in sorted(clusters, key=lambda i: (i % tasks, i))
                 if cost(clusters[i], x) > MIN_COST * clusters[i]["n"]]
        needed = {k: n for k, n in needed.items() if n}
        if not nodes or not needed:
            break
        whole = [k for k, n in needed.items() if n >= len(nodes)]
        part = {k: n for k, n in needed.items() if n < len(nodes)}
        largest = sorted(nodes, key=lambda i: -clusters[i]["n"])[:max(part.values(), default=0)]
        centres = {i: mean(clusters[i], x) for i in nodes}
        noise = uniform(rows.sparkSession, seed, drawn + len(x) * len(nodes))[drawn:]
        halves = {v: first_halves(some, centres, noise)
                  for v, some in (("whole", nodes if whole else []), ("part", largest)) if some}
        halves, found = _rounds(rows, tree, halves, x)
        for k, n in part.items():
            own = {i: halves["part"][i] for i in largest[:n]}
            done[k] = BisectedModel({**tree, **own}, root, features_col)
        if not whole:
            return done
        tree = {**tree, **halves["whole"]}
        drawn += len(x) * len(nodes)
        needed = {k: needed[k] - len(nodes) for k in whole}
        for k in whole:
            done[k] = BisectedModel(tree, root, features_col)
        clusters = found["whole"]
    return done | {k: BisectedModel(tree, root, features_col) for k in ks if k not in done}


def _rounds(rows: DataFrame, tree: Halves, halves: dict[str, Halves], x: list[str]
            ) -> tuple[dict[str, Halves], dict[str, dict[int, Row]]]:
    """The centres after all rounds, and the sums of the last one."""
    for _ in range(ROUNDS):
        found = sums(rows, {v: place({**tree, **h}, x, {j: j for c in h.values() for j in c})
                            for v, h in halves.items()}, x)
        moved = {v: {i: {j: mean(found[v][j], x) for j in (2 * i, 2 * i + 1) if j in found[v]}
                     for i in h} for v, h in halves.items()}
        if moved == halves:    # later rounds would find the same
            break
        halves = moved
    return halves, found
