"""Train and detect.

``train`` fits the preparation on the training table, caches only the
coordinate vector, chooses k by silhouette and keeps the winning model.

``AnomalyModel.detect`` scores a second table lazily: by default the
preparation is fitted again on the scored table (the reference's behaviour;
``refit=False`` reuses the training fit). Each row's distance to its nearest
centre is a column expression over literal centres; one aggregation gives the
mean and std; rows with ``distance > mean + n_sigma * std`` are flagged. The
source columns travel with each row, so a flagged row is always reported
with its own values, even when rows were skipped for null strings.

Jobs per detection: one scan to fit the preparation (refit only), one scan
for the distance statistics, and the scan of whoever consumes ``flagged``.
Nothing row-sized is collected. ``one_scan`` reads the scored table once instead:
see ``AnomalyModel.detect``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.alerts import format_alerts, resolve_id_column
from ..functions.distance import metric_by_name, nearest_centre, nearest_distance
from ..operators import clustering
from ..operators.detection import (DEFAULT_SIGMA, DistanceStats, distance_stats,
                                   rule_by_name, sigma_predicate, sqrt_predicate)
from ..operators.features import FeatureModel, fit_features
from ..sinks import console_lines
from ..session import drop_path, ensure_checkpoint_dir, materialise_at, tune_codegen

DISTANCE_COL = "distance"
THRESHOLD_COL = "threshold"


def spread(rows: DataFrame, partitions: int | None) -> DataFrame:
    """Optionally deal the chosen columns over ``partitions`` tasks by their values.

    Off by default: k-means|| starts from the rows as they are split, and the
    default keeps the input's own split (as the reference does). Rows dealt by
    value and sorted start it alike whatever the input's files, splits or cores;
    what is left are last-bit differences of the standard deviations.
    """
    if not partitions:
        return rows
    key = [F.col(f"`{c}`") for c in rows.columns]
    return rows.repartition(partitions, *key).sortWithinPartitions(*key)


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores before it while a column has that name."""
    lowered = {c.lower() for c in columns}
    while name.lower() in lowered:
        name = f"_{name}"
    return name


def required(value, *inputs):
    """``value``, or an error on a row where an input is null or NaN."""
    bad = F.lit(False)
    for column in inputs:
        bad = bad | column.isNull() | F.isnan(column)
    return F.when(bad, F.raise_error(F.lit(
        "a numeric feature of a scored row is null or NaN"))).otherwise(value)


def _require_batch(df: DataFrame) -> None:
    if df.isStreaming:
        raise ValueError("train/detect take a batch DataFrame; score a stream with "
                         "farpoint.streaming.detect_each_batch")


def checkpointed(frame: DataFrame) -> tuple[DataFrame, str | None]:
    """``frame`` written to the checkpoint folder, row order and split unchanged,
    and the written path (for ``drop_path``)."""
    ensure_checkpoint_dir(frame.sparkSession)
    out = frame.checkpoint(eager=True)
    file = out._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    return out, file.get() if file.isDefined() else None


@dataclass
class Detection:
    """Result of scoring one table; DataFrames are lazy."""

    scored: DataFrame            # source columns + distance
    flagged: DataFrame           # rows over the cut: source columns + distance (+ threshold)
    stats: DistanceStats | None
    threshold: float | None
    n_sigma: float | None
    rule: str
    id_col: str
    source_columns: list[str]
    scans: int | None = None     # of the scored table, where ``one_scan`` was asked for
    staged: str | None = None    # written distances and candidates that ``flagged`` reads

    def drop(self) -> None:
        """Delete what ``one_scan`` wrote; ``flagged`` cannot be read afterwards."""
        if self.staged is not None:
            drop_path(self.flagged.sparkSession, self.staged)

    def alerts(self) -> DataFrame:
        """One ``value`` line per flagged row."""
        return format_alerts(self.flagged, self.id_col, self.source_columns)

    def found(self) -> bool:
        """A5. Under the sigma rule this is ``max(distance) > threshold``,
        known from the statistics job; the sqrt rule looks for a first row."""
        if self.stats is not None and self.threshold is not None:
            return self.stats.max is not None and self.stats.max > self.threshold
        return not self.flagged.isEmpty()

    def report(self, n: int = 20) -> list[str]:
        """Console form (K4): the first ``n`` alert lines and a notice if there are
        more, or the none-found message. The job prints every line by default."""
        return console_lines(self.alerts(), n)


@dataclass
class AnomalyModel:
    """A fitted clustering model plus what is needed to score new tables.

    ``centres`` (k lists of coordinates) and ``preparation`` are all scoring
    needs. ``mllib_model`` is kept for MLlib's own ``transform``; its training
    summary is not usable, since the coordinate table it points to is deleted
    once the search ends.
    """

    algorithm: str
    features: list[str]
    centres: list[list[float]]
    preparation: FeatureModel
    k: int
    seed: int = clustering.SEED
    silhouettes: dict[int, float] = field(default_factory=dict)
    mllib_model: object | None = None
    spread: dict[str, DistanceStats] = field(default_factory=dict)   # of training rows, by metric

    @property
    def default_sigma(self) -> float:
        return DEFAULT_SIGMA[self.algorithm]

    def score(self, df: DataFrame, metric: str = "euclidean", refit: bool = True,
              preparation: FeatureModel | None = None,
              strict: bool = False) -> tuple[DataFrame, list[str]]:
        """Source columns + ``distance`` for every kept row (D4 + J1).

        ``strict`` raises on a null or NaN numeric feature while rows are read.
        """
        metric = metric_by_name(metric)
        tune_codegen(df.sparkSession)
        source_columns = list(df.columns)
        prep = preparation or (fit_features(df, self.features, layout=self.preparation.layout)
                               if refit else self.preparation)
        if prep.base_columns != self.preparation.base_columns:
            raise ValueError("scored table gives a different feature layout "
                             f"({prep.base_columns} vs {self.preparation.base_columns})")
        indexed, back = self._indexed(prep, df)
        dist = nearest_distance(prep.layout_columns(), self.centres, metric)
        if strict:
            dist = required(dist, *prep.raw_columns())
        scored = indexed.select(*back, dist.alias(free_name(source_columns, DISTANCE_COL)))
        return scored, source_columns

    @staticmethod
    def _indexed(prep: FeatureModel, df: DataFrame) -> tuple[DataFrame, list]:
        """``df`` with the index columns, and its own columns under their own names."""
        taken = {c: f"__fp_source_{i}" for i, c in enumerate(df.columns)
                 if c in prep.added_columns}
        indexed = prep.index(df.withColumnsRenamed(taken))
        return indexed, [F.col(taken.get(c, c)).alias(c) for c in df.columns]

    def assign(self, df: DataFrame, metric: str = "euclidean", refit: bool = True) -> DataFrame:
        """Source columns + index of the nearest centre."""
        tune_codegen(df.sparkSession)
        prep = fit_features(df, self.features, layout=self.preparation.layout) if refit \
            else self.preparation
        indexed, back = self._indexed(prep, df)
        nearest = nearest_centre(prep.layout_columns(), self.centres, metric)
        return indexed.select(*back, required(nearest, *prep.raw_columns())
            .alias(free_name(df.columns, "prediction")))

    def detect(self, df: DataFrame, metric: str = "euclidean", *, n_sigma: float | None = None,
               refit: bool = True, rule: str = "sigma", id_col: str | None = None,
               preparation: FeatureModel | None = None,
               stage_features: bool = False, one_scan: bool = False) -> Detection:
        """Score ``df`` and flag rows far from every centre.

        ``stage_features`` is for row-format sources (CSV, JSON, Kafka),
        where every pass parses whole rows: the chosen columns are written
        once to the shared folder, the refit and the statistics read that
        narrow table, and only the final flag pass reads the source again.

        ``one_scan`` reads the source once where no refit is asked for (``refit=False``
        or a given ``preparation``): see ``_one_scan``.
        """
        rule = rule_by_name(rule)
        if one_scan:
            if rule != "sigma" or (refit and preparation is None):
                raise ValueError("one_scan needs the sigma rule and a preparation that is fitted "
                                 "already (refit=False, or preparation=)")
            _require_batch(df)
            return self._one_scan(df, metric_by_name(metric), n_sigma, id_col, preparation)
        _require_batch(df)
        id_name = resolve_id_column(df, id_col)
        staged = None
        if stage_features and preparation is None and (refit or rule == "sigma"):
            staged, staged_path = materialise_at(df.select(*self.features), "score-features")
            if refit:
                preparation = fit_features(staged, self.features,
                                           layout=self.preparation.layout)
        try:
            scored, source_columns = self.score(df, metric, refit, preparation,
                                                strict=rule == "sqrt")
            distance = free_name(source_columns, DISTANCE_COL)
            dist = F.col(distance)
            if rule == "sqrt":
                return Detection(scored, scored.where(sqrt_predicate(dist)), None, None, None,
                                 rule, id_name, source_columns)
            sigma = self.default_sigma if n_sigma is None else float(n_sigma)
            if staged is not None:
                stats_input, _ = self.score(staged, metric, refit,
                                            preparation if refit else None)
            else:
                stats_input = scored
            stats = distance_stats(stats_input, stats_input.columns[-1])
        finally:
            if staged is not None:
                drop_path(df.sparkSession, staged_path)
        threshold = stats.threshold(sigma)
        flagged = (scored.where(sigma_predicate(dist, threshold))
                   .withColumn(free_name(source_columns, THRESHOLD_COL),
                               F.lit(float(threshold))))
        return Detection(scored, flagged, stats, threshold, sigma, rule, id_name, source_columns)

    def _one_scan(self, df: DataFrame, metric: str, n_sigma: float | None,
                  id_col: str | None, preparation: FeatureModel | None) -> Detection:
        """The same flags as ``detect``, from one read of ``df``.

        One pass writes every row's distance, and whole rows only where the distance is
        above a lower bound of the cut: half of the training rows' own. Statistics and
        flagged rows are then read from that narrow table. The bound only decides what is
        written: if the exact threshold turns out to be below it, rows between the two are
        missing, and the flagged rows come from a second scan of the source instead.
        """
        id_name = resolve_id_column(df, id_col)
        sigma = self.default_sigma if n_sigma is None else float(n_sigma)
        known = self.spread.get(metric)
        bound = known.threshold(sigma) / 2 if known is not None else 0.0
        scored, columns = self.score(df, metric, False, preparation)
        distance = free_name(columns, DISTANCE_COL)
        far = F.col(distance) > F.lit(bound)
        row = F.struct(*[F.col(f"`{c}`") for c in columns])
        staged, path = materialise_at(scored.select(
            F.col(distance).alias("d"), F.when(far, row).alias("row")), "scored-once")
        try:
            stats = distance_stats(staged, "d")
        except ValueError:
            drop_path(df.sparkSession, path)
            raise
        threshold = stats.threshold(sigma)
        cut = (free_name(columns, THRESHOLD_COL), F.lit(float(threshold)))
        scans = 1 if threshold >= bound else 2
        if scans == 1:
            flagged = staged.where(sigma_predicate(F.col("d"), threshold)).select(
                "row.*", F.col("d").alias(distance)).withColumn(*cut)
        else:
            drop_path(df.sparkSession, path)
            path = None
            flagged = scored.where(sigma_predicate(F.col(distance), threshold)).withColumn(*cut)
        return Detection(scored, flagged, stats, threshold, sigma, "sigma", id_name, columns,
                         scans, path)

    @classmethod
    def from_centres(cls, algorithm: str, features: list[str], centres: list[list[float]],
                     preparation: FeatureModel) -> AnomalyModel:
        """A model with given centres (for testing the scoring path on centres
        that are not the output of a fit)."""
        algo = clustering.algorithm_by_name(algorithm)
        dim = preparation.dimension
        for c in centres:
            if len(c) != dim:
                raise ValueError(f"centre has {len(c)} coordinates, expected {dim}")
        return cls(algo, list(features), [list(map(float, c)) for c in centres],
                   preparation, len(centres))


def train(df: DataFrame, features: list[str], algorithm: str = "kMeans", *,
          k: int | None = None, k_min: int = clustering.K_MIN, k_max: int = clustering.K_MAX,
          seed: int = clustering.SEED, layout: str = "3n",
          parallelism: int | None = None, partitions: int | None = None,
          cache: bool = True, stage_features: bool = False,
          spread: tuple[str, ...] = ()) -> AnomalyModel:
    """Fit the preparation and a clustering model on ``df``.

    With ``k`` given, the silhouette search is skipped. ``parallelism`` runs
    that many search fits at once; ``partitions`` deals the rows by value, which
    makes the model independent of how the input is split.
    ``cache=False`` re-derives the coordinates from the source on every pass
    (what the reference does; only useful to measure the written table's worth).
    ``stage_features`` (for CSV / JSON / Kafka sources) writes the chosen
    columns once, so the fit and the coordinate pass do not parse the source
    rows twice. ``spread`` names metrics for which the model keeps the statistics of the
    training rows' distances, one more scan of the coordinates each: the bound that
    ``detect(one_scan=True)`` starts from.

    The coordinates are checkpointed once in the shared checkpoint folder, in
    the order and split they have: the fits and silhouette passes read that
    compact copy instead of the source and a lost executor costs a re-read, not
    a re-preparation. The model is the one that ``cache=False`` and a direct
    MLlib fit on the same coordinates give. The copy is deleted after the fits.
    """
    algo = clustering.algorithm_by_name(algorithm)
    _require_batch(df)
    staged_path = None
    if stage_features:
        df, staged_path = materialise_at(df.select(*features), "train-features")
    try:
        return _train(df, features, algo, k, k_min, k_max, seed, layout, parallelism,
                      partitions, cache, spread)
    finally:
        if staged_path is not None:
            drop_path(df.sparkSession, staged_path)


def _train(df, features, algo, k, k_min, k_max, seed, layout, parallelism, partitions,
           cache, metrics) -> AnomalyModel:
    prep = fit_features(df, features, layout=layout)
    if prep.rows_kept == 0:
        raise ValueError("no rows left to train on (empty table, or every row has a "
                         "null string feature)")
    frame = prep.vectors(spread(df.select(*features), partitions))
    written = None
    if cache:
        frame, written = checkpointed(frame)
    if parallelism is None:
        parallelism = clustering.default_search_parallelism(
            prep.rows_kept, prep.dimension, k_max - k_min + 1)
    try:
        if k is not None:
            model = clustering.fit(frame, algo, k, seed)
            scores: dict[int, float] = {}
            best_k = k
        else:
            found = clustering.search_k(frame, algo, k_min, k_max, seed, parallelism=parallelism)
            model, scores, best_k = found.model, found.scores, found.k
        centres = [list(map(float, c)) for c in model.clusterCenters()]
        points = frame.select(vector_to_array("features").alias("x"))
        x = [F.col("x")[i] for i in range(prep.dimension)]
        spreads = {m: distance_stats(points.select(nearest_distance(x, centres, m).alias("d")), "d")
                   for m in map(metric_by_name, metrics)}
    finally:
        if written is not None:     # the model keeps only centres, not the table
            drop_path(df.sparkSession, written)
    return AnomalyModel(algo, list(features), centres, prep, best_k, seed, scores, model, spreads)
