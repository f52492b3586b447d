"""Distance statistics, thresholds and the anomaly predicates.

All statistics are global: one aggregation with map-side partials, so the
shuffle carries a few rows per task (one for each exponent that occurs, see
``moments``) whatever the table size, and never a global window (which would pull
every row into one partition). Sums are exact, so the threshold is the same to the
last bit however the table is split, and a strict cut always flags the same rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .moments import Moments, limb_columns, limb_sums, whole

# Fixed values from the reference: sigma multiplier per algorithm (its
# comments say 2; its code uses these).
DEFAULT_SIGMA = {"kmeans": 4.0, "bisectingkmeans": 3.0}
RULES = ("sigma", "sqrt")


@dataclass(frozen=True)
class DistanceStats:
    count: int
    mean: float
    std: float
    max: float | None = None

    def threshold(self, n_sigma: float) -> float:
        """``mean + n_sigma * std`` (A3 / A4)."""
        return self.mean + n_sigma * self.std


def stats_rows(scored: DataFrame, distance_col: str = "distance") -> DataFrame:
    """The statistics aggregate, lazily: one row for each exponent of the distances."""
    split = whole(scored.select(F.col(f"`{distance_col}`").cast("double").alias("d")), "d", "d")
    return (split.selectExpr("d", "e", *limb_columns()).groupBy("e")
            .agg(F.count("d").alias("n"), F.count(F.lit(1)).alias("rows"), F.max("d").alias("max"),
                 F.expr("sum(cast(isnan(d) as bigint)) as nans"), *limb_sums()))


def distance_stats(scored: DataFrame, distance_col: str = "distance") -> DistanceStats:
    """A1 + A2 in one job; a bounded number of rows reaches the driver, one for each
    exponent. The maximum comes with them, so "was anything flagged" needs no further
    pass (A5).

    A null or NaN distance comes from a null or NaN numeric feature, which
    the reference's assembler rejects; the same job counts them and raises.
    """
    rows = stats_rows(scored, distance_col).collect()
    n = sum(r["n"] for r in rows)
    bad = sum(r["rows"] for r in rows) - n + sum(r["nans"] or 0 for r in rows)
    if bad:
        raise ValueError(f"{bad} scored row(s) have a null or NaN numeric feature")
    top = max((r["max"] for r in rows if r["max"] is not None), default=None)
    if top == math.inf:
        return DistanceStats(n, math.inf, math.nan if n > 1 else 0.0, top)
    found = Moments.of(n, rows)
    return DistanceStats(n, found.mean, found.std, top)


def sigma_predicate(distance: Column, threshold: float) -> Column:
    """Strict ``distance > threshold`` (P5)."""
    return distance > F.lit(float(threshold))


def sqrt_predicate(distance: Column) -> Column:
    """Per-row rule ``d > 2 * sqrt(d)`` (P7); needs no table statistics."""
    return distance > F.lit(2.0) * F.sqrt(distance)


def rule_by_name(name: str) -> str:
    key = (name or "").lower()
    if key not in RULES:
        raise ValueError(f"unknown rule {name!r}; expected one of {RULES}")
    return key
