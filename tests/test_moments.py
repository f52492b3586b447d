"""Exact sums: against fractions, for any magnitude, and for any split of the table."""

import math
import random
import statistics
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from farpoint.operators.detection import distance_stats
from farpoint.operators.features import fit_features
from farpoint.operators.moments import whole
from farpoint.plans.catalogue import EVENT_FEATURES, group_centres
from farpoint.plans.model import AnomalyModel


def doubles(n=600, seed=5):
    rnd = random.Random(seed)
    found = [rnd.choice([-1, 1]) * rnd.random() * 2.0 ** rnd.randint(-1070, 1020)
             for _ in range(n)]
    found += [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 1.7976931348623157e308, 2.0 ** -400,
              2.0 ** 53 - 1, 2.0 ** 53, 0.1, 2.2250738585072014e-308]
    return found + [2.0 ** e for e in range(-1074, 1024, 3)] \
        + [math.nextafter(2.0 ** e, 0) for e in range(-1000, 1024, 7)]


def test_every_double_is_a_whole_number_times_a_power_of_two(spark):
    values = doubles()
    rows = whole(spark.createDataFrame([(v,) for v in values], "x double"), "x", "x").collect()
    for row in rows:
        if row["x"] == 0:
            assert row["m"] is None and row["e"] is None
        else:
            assert abs(row["m"]) < 2 ** 56
            assert Fraction(row["x"]) == row["m"] * Fraction(2) ** row["e"]


@pytest.mark.parametrize("values", [
    doubles(), [0.1] * 1000, [1e16, 1.0, -1e16] * 50, [1e200, 1e-200, 3.5] * 9,
    [1e9 + i * 1e-6 for i in range(500)], [5e-324, 1e-320, 3e-310], [0.0, 0.0], [-2.5]],
    ids=["wide", "tenths", "cancelling", "far apart", "close", "tiny", "zeros", "one"])
def test_mean_and_deviation_are_those_of_the_exact_sums(spark, values):
    found = distance_stats(spark.createDataFrame([(v,) for v in values], "distance double")
                           .repartition(3))
    exact = [Fraction(v) for v in values]
    assert found.count == len(values) and found.max == max(values)
    assert found.mean == float(sum(exact) / len(exact))
    if len(values) > 1:
        spread = statistics.variance(exact)
        if spread < Fraction(1.7e308) and spread > Fraction(2.0 ** -900):
            assert found.std == pytest.approx(math.sqrt(spread), rel=1e-15)
        assert abs(Fraction(found.std) ** 2 - spread) <= spread / 10 ** 15 or found.std < 1e-300
    else:
        assert found.std == 0.0


def test_empty_infinite_and_missing_distances(spark):
    frame = lambda vs: spark.createDataFrame([(v,) for v in vs], "distance double")
    empty = distance_stats(frame([]))
    assert (empty.count, empty.mean, empty.std, empty.max) == (0, 0.0, 0.0, None)
    far = distance_stats(frame([1.0, math.inf]))
    assert far.mean == far.max == math.inf and math.isnan(far.std)
    for bad in (None, math.nan):
        with pytest.raises(ValueError, match="null or NaN"):
            distance_stats(frame([1.0, bad]))


def test_threshold_is_bit_equal_for_any_split(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").cache()
    prep = fit_features(events, EVENT_FEATURES)
    model = AnomalyModel.from_centres("kMeans", EVENT_FEATURES,
                                      group_centres(prep, events, "event_type"), prep)
    found, scales = set(), set()
    for parts in (1, 7, 40):
        dealt = events.repartition(parts, F.rand(parts))
        det = model.detect(dealt, id_col="event_id", n_sigma=1.5)       # preparation refitted
        found.add((det.threshold, det.stats.mean, det.stats.std,
                   tuple(sorted(r["event_id"] for r in det.flagged.collect()))))
        scales.add(tuple(fit_features(dealt, EVENT_FEATURES).stds))
    assert len(found) == 1 and len(scales) == 1
    events.unpersist()


def test_a_strict_cut_at_the_threshold_itself(spark):
    """A row exactly at mean + n sigma is not flagged, however the rows are split."""
    values = [0.1] * 9999 + [0.3]
    exact = [Fraction(v) for v in values]
    mean = sum(exact) / len(exact)
    rows = spark.createDataFrame([(v,) for v in values], "distance double")
    cuts = {distance_stats(rows.repartition(p)).threshold(4.0) for p in (1, 7, 40)}
    assert len(cuts) == 1
    assert cuts.pop() == pytest.approx(float(mean) + 4 * math.sqrt(statistics.variance(exact)),
                                       rel=1e-15)
