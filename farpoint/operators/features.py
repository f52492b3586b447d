"""Feature preparation: projection, string indexing, assembly and scaling.

Semantics kept from the reference (SURVEY §2.2-2.3):

* The chosen columns are split into numeric ones (kept in the chosen order)
  and string ones; each string column becomes ``<name>_index`` and the base
  vector is ``[numeric..., string_index...]`` (not the chosen order).
* String columns are indexed one after another with "skip" for invalid
  input, so a column's label counts are taken over rows whose *earlier*
  string columns are non-null, and a row with any null string is dropped.
* Scaling divides by the sample standard deviation (no centring); a constant
  column scales to 0.0.
* The clustering vector has 3n entries: ``[raw n, raw n again, scaled n]``.
* A null or NaN in a numeric feature is an error.

Fitting reads the table once: one aggregation (map-side combined, so a hot
label costs one partial row per task) returns every label count together
with the numeric spreads and null/NaN counts. Numeric spreads come from exact
sums (``moments``), so they don't depend on how the table is split.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_path, materialise_at
from .indexing import LabelTable, distributed_label_tables, local_label_tables
from .moments import Moments, limb_columns, limb_sums, whole

# Largest label table ranked on the driver and broadcast: both the number
# of distinct labels (all string columns together) and their total UTF-8
# size are checked before anything is collected; above either bound the
# distributed path is used.
MAX_LOCAL_LABELS = 100_000
MAX_LOCAL_LABEL_BYTES = 32 * 1024 * 1024

LAYOUTS = ("3n", "scaled")

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType, T.BooleanType)


def split_features(df: DataFrame, features: list[str]) -> tuple[list[str], list[str]]:
    """Return (numeric, string) feature names, each in the chosen order."""
    if not features:
        raise ValueError("at least one feature column is required")
    if len(set(features)) != len(features):
        raise ValueError(f"feature list has repeated names: {features}")
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric, strings = [], []
    for name in features:
        if name not in types:
            raise ValueError(f"unknown feature column {name!r}; table has {list(types)}")
        dtype = types[name]
        if isinstance(dtype, T.StringType):
            strings.append(name)
        elif isinstance(dtype, _NUMERIC):
            numeric.append(name)
        else:
            raise ValueError(
                f"feature column {name!r} has type {dtype.simpleString()}; only numeric, "
                "boolean and string columns can be features")
    return numeric, strings


def string_columns(df: DataFrame, features: list[str]) -> list[str]:
    """Names of the chosen columns whose type is string."""
    return split_features(df, features)[1]


def index_name(column: str) -> str:
    return f"{column}_index"


@dataclass
class FeatureModel:
    """Fitted preparation: label tables plus per-column scale factors."""

    features: list[str]
    numeric: list[str]
    strings: list[str]
    labels: list[LabelTable]
    stds: list[float]           # per base column: numeric..., index...
    rows_seen: int              # rows in the fitted table
    rows_kept: int              # rows left after the null-string skip
    layout: str = "3n"
    _factors: list[float] = field(default_factory=list, repr=False)

    def __post_init__(self) -> None:
        if self.layout not in LAYOUTS:
            raise ValueError(f"unknown layout {self.layout!r}; expected one of {LAYOUTS}")
        # MLlib's scaler multiplies by 1/std, and by 0 when std is 0.
        self._factors = [1.0 / s if s != 0.0 else 0.0 for s in self.stds]

    @property
    def base_columns(self) -> list[str]:
        return list(self.numeric) + [index_name(s) for s in self.strings]

    @property
    def added_columns(self) -> list[str]:
        """Columns that ``index`` adds."""
        return [index_name(t.column) for t in self.labels]

    @property
    def dimension(self) -> int:
        n = len(self.base_columns)
        return 3 * n if self.layout == "3n" else n

    @property
    def factors(self) -> list[float]:
        return list(self._factors)

    def index(self, df: DataFrame) -> DataFrame:
        """Add ``<s>_index`` columns; rows with null/unknown labels are skipped."""
        for table in self.labels:
            if index_name(table.column) in df.columns:
                raise ValueError(f"column {index_name(table.column)!r} already exists")
            df = table.join_onto(df)
        return df

    def drop(self) -> None:
        """Delete label tables that were written for this preparation; it is of no use
        afterwards. For one that scores a single table, as in a stream."""
        for path in {t.path for t in self.labels if t.path is not None}:
            frame = next(t.frame for t in self.labels if t.path == path)
            drop_path(frame.sparkSession, path)

    def raw_columns(self) -> list[Column]:
        return [F.col(c).cast("double") for c in self.base_columns]

    def scaled_columns(self) -> list[Column]:
        return [F.col(c).cast("double") * F.lit(f)
                for c, f in zip(self.base_columns, self._factors)]

    def layout_columns(self) -> list[Column]:
        """The clustering coordinates as column expressions, in vector order."""
        raw = self.raw_columns()
        if self.layout == "scaled":
            return self.scaled_columns()
        return raw + self.raw_columns() + self.scaled_columns()

    def transform(self, df: DataFrame) -> DataFrame:
        """Index, then add ``f_0 .. f_{d-1}`` coordinate columns."""
        out = self.index(df)
        cols = self.layout_columns()
        return out.select("*", *[c.alias(f"f_{i}") for i, c in enumerate(cols)])

    def vectors(self, df: DataFrame, output_col: str = "features",
                keep: list[str] | None = None) -> DataFrame:
        """One MLlib vector column with the clustering coordinates (plus the
        ``keep`` columns, e.g. a key)."""
        from pyspark.ml.functions import array_to_vector
        keep = [c for c in (keep or []) if c not in self.features]
        indexed = self.index(df.select(*keep, *self.features))
        return indexed.select(*keep, array_to_vector(F.array(*self.layout_columns()))
                              .alias(output_col))


def _label_col(pos: int) -> str:
    return f"__fp_label_{pos}"


def fit_statistics(df: DataFrame, numeric: list[str], strings: list[str]) -> DataFrame:
    """The one-scan fitting aggregate, as a lazy DataFrame.

    One output row per (position, label, e). Position 0 (label and e null) carries the
    row counts. Position -1 - i carries, for numeric column i, over rows kept by every
    null skip, ``cnt`` and ``nan`` and the limb sums of its exact moments, one row for
    each exponent ``e``. Position j >= 1 carries, for string column j, each label's count
    ``n_fit`` over rows whose strings 1..j are non-null (the ordering count) and
    ``n_kept`` over fully kept rows.
    """
    # prefix[j]: strings 0..j are all non-null (row survives indexer j).
    prefix: list[Column] = []
    cond = None
    for s in strings:
        cond = F.col(s).isNotNull() if cond is None else cond & F.col(s).isNotNull()
        prefix.append(cond)
    kept = prefix[-1] if prefix else F.lit(True)

    def record(pos: int, label: Column, fit_flag: Column, x: Column) -> Column:
        return F.struct(F.lit(pos).alias("pos"), label.cast("string").alias("label"),
                        fit_flag.cast("long").alias("w_fit"), kept.cast("long").alias("w_kept"),
                        x.cast("double").alias("x"))

    null = F.lit(None)
    records = [record(0, null, F.lit(True), null)]
    records += [record(-1 - i, null, kept, F.col(c)) for i, c in enumerate(numeric)]
    records += [record(j, F.col(s), prefix[j - 1], null) for j, s in enumerate(strings, 1)]
    keys = ["pos", "label", "w_fit", "w_kept", "x"]
    split = whole(df.select(F.inline(F.array(*records))).where("w_fit = 1"), "x", *keys)
    return (split.selectExpr(*keys, "e", *limb_columns()).groupBy("pos", "label", "e")
            .agg(F.sum("w_fit").alias("n_fit"), F.sum("w_kept").alias("n_kept"),
                 F.count("x").alias("cnt"), F.expr("sum(cast(isnan(x) as bigint)) as nan"),
                 F.expr("max(abs(x)) as size"), *limb_sums()))


def numeric_spread(name: str, rows: list, rows_kept: int) -> float:
    """Sample std of a numeric column from its exact sums; nulls and NaN are errors."""
    nulls = rows_kept - sum(r["cnt"] for r in rows)
    nans = sum(r["nan"] or 0 for r in rows)
    if nulls:
        raise ValueError(f"numeric feature {name!r} has {nulls} null value(s); "
                         "null numbers are an error (rows with a null string feature "
                         "are skipped instead)")
    if nans:
        raise ValueError(f"numeric feature {name!r} has {nans} NaN value(s)")
    if any(r["size"] == math.inf for r in rows):
        return math.nan if rows_kept > 1 else 0.0
    return Moments.of(rows_kept, rows).std


def fit_features(df: DataFrame, features: list[str], *, layout: str = "3n",
                 max_local_labels: int = MAX_LOCAL_LABELS) -> FeatureModel:
    """Fit indexing and scaling on ``df`` (one scan of the chosen columns)."""
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}; expected one of {LAYOUTS}")
    numeric, strings = split_features(df, features)
    spark = df.sparkSession
    stats = fit_statistics(df, numeric, strings)

    # One row per distinct label, and few others: collect only when within the
    # bounds. The (label-sized) result is persisted, so the size check, the
    # collect or the write-out all reuse one scan of the table.
    held = stats.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        size = held.agg(F.count("label").alias("n"),
                        F.sum(F.octet_length("label")).alias("bytes")).first()
        local = (int(size["n"]) <= max_local_labels
                 and int(size["bytes"] or 0) <= MAX_LOCAL_LABEL_BYTES)
        head = held.collect() if local else []
        if not local:
            stats, stats_path = materialise_at(held, "feature-stats")
            top = stats.where(F.col("pos") <= 0).collect()
        else:
            top = [r for r in head if r["pos"] <= 0]
    finally:
        held.unpersist()
    row0 = next((r for r in top if r["pos"] == 0), None)
    rows_seen = int(row0["n_fit"]) if row0 else 0
    rows_kept = int(row0["n_kept"] or 0) if row0 else 0
    num_stds = [numeric_spread(name, [r for r in top if r["pos"] == -1 - i], rows_kept)
                for i, name in enumerate(numeric)]

    label_cols = [_label_col(j) for j in range(1, len(strings) + 1)]
    index_cols = [index_name(s) for s in strings]
    if not strings:
        tables: list[LabelTable] = []
    elif local:
        rows = [(r["pos"], r["label"], int(r["n_fit"]), int(r["n_kept"] or 0))
                for r in head if r["pos"] > 0]
        tables = local_label_tables(spark, strings, rows, label_cols, index_cols)
    else:
        counts = stats.where(F.col("pos") > 0).select(
            "pos", "label", "n_fit", F.coalesce("n_kept", F.lit(0)).alias("n_kept"))
        tables = distributed_label_tables(counts, strings, label_cols, index_cols)
        drop_path(spark, stats_path)       # the ranked label table is written

    stds = num_stds + [t.std if rows_kept > 1 else 0.0 for t in tables]
    return FeatureModel(list(features), numeric, strings, tables, stds,
                        rows_seen, rows_kept, layout)
