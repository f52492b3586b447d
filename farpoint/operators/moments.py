"""Exact sums: count, mean and sample deviation that don't depend on the order of rows.

Adding doubles rounds at every step, so a sum depends on how rows are split, and a strict
``distance > threshold`` can flip with it. Here nothing is rounded before the end. A double
is a whole number m times a power of two, 2**e. Rows are grouped by e, and m and m*m are
summed as whole numbers, in limbs of 19 bits: long sums that stay exact for 2**44 rows,
combined on the map side and merged in any order. What reaches the driver is at most one
row for each exponent met (a few dozen as a rule, some 2,100 at most, whatever the table);
there the sums are put together as fractions and rounded once.

All of it is built-in arithmetic over long and double columns, so it stays in the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

LIMB = 19                     # bits of a summed limb
HALF = 28                     # bits of the lower half of m, for m * m
# Doubles below 2**SMALL are scaled up first, so that no power of two leaves the normal range.
SMALL, LIFT = -400, 600
STEPS = range(-31, 18)        # powers 2**(32 * step) that a scale is made of
LIMBS = [f"s{i}" for i in range(3)] + [f"q{p}{i}" for p in range(3) for i in range(3)]


# The expressions are SQL text: hundreds of Column calls would cost more than small queries.

def _power(exponent: str) -> str:
    """2.0 ** exponent, exactly, for exponents between -992 and 575."""
    coarse = ", ".join(f"{2.0 ** (32 * s)!r}D" for s in STEPS)
    return (f"element_at(array({coarse}), shiftright({exponent}, 5) + {1 - STEPS.start}) "
            f"* cast(shiftleft(1L, ({exponent}) & 31) as double)")


def whole(df: DataFrame, x: str, *keep: str) -> DataFrame:
    """The ``keep`` columns, and (e, m) with x = m * 2**e, exactly.

    Both are null where x is zero, null, NaN or infinite. The exponent from ``log2`` may
    be off by one, which the spare bits of m allow for.
    """
    finite = f"if(abs({x}) > 0 and abs({x}) < double('Infinity'), {x}, null)"
    lifted = f"abs({x}) < {2.0 ** SMALL!r}D"
    return (df.selectExpr(*keep, f"if({lifted}, {finite} * {2.0 ** LIFT!r}D, {finite}) as y",
                          f"if({lifted}, {LIFT}, 0) as lift")
            .selectExpr(*keep, "y", "lift", "cast(floor(log2(abs(y))) as int) as top")
            .selectExpr(*keep, "top - 53 - lift as e",
                        f"cast(y * ({_power('53 - top')}) as bigint) as m"))


def limb_columns() -> list[str]:
    """The limbs of m and of the three products that make up m * m, in ``LIMBS`` order."""
    mask = (1 << LIMB) - 1
    low, high = f"(abs(m) & {(1 << HALF) - 1}L)", f"shiftright(abs(m), {HALF})"
    parts = [part for v in ("m", f"({low} * {low})", f"({low} * {high})", f"({high} * {high})")
             for part in (f"{v} & {mask}L", f"shiftright({v}, {LIMB}) & {mask}L",
                          f"shiftright({v}, {2 * LIMB})")]
    return [f"{c} as {n}" for c, n in zip(parts, LIMBS, strict=True)]


def limb_sums() -> list[Column]:
    return [F.expr(f"sum({n}) as {n}") for n in LIMBS]


@dataclass(frozen=True)
class Moments:
    """Exact count, sum and sum of squares."""

    n: int
    total: Fraction
    squares: Fraction

    @classmethod
    def of(cls, n: int, rows: Iterable[Row]) -> Moments:
        """From one row of limb sums for each exponent ``e``; null exponents add nothing."""
        total = squares = Fraction(0)
        for row in rows:
            if row["e"] is None:
                continue
            limbs = [int(row[name]) for name in LIMBS]
            value = [sum(v << (LIMB * i) for i, v in enumerate(limbs[at:at + 3]))
                     for at in range(0, len(LIMBS), 3)]
            square = value[1] + (value[2] << (HALF + 1)) + (value[3] << (2 * HALF))
            total += value[0] * Fraction(2) ** row["e"]
            squares += square * Fraction(4) ** row["e"]
        return cls(n, total, squares)

    @property
    def mean(self) -> float:
        return float(self.total / self.n) if self.n else 0.0

    @property
    def std(self) -> float:
        """Sample standard deviation; 0 for fewer than two values."""
        if self.n < 2:
            return 0.0
        spread = (self.squares - self.total * self.total / self.n) / (self.n - 1)
        if not spread:
            return 0.0
        # a whole number with over 120 bits under the root, whatever the magnitude
        size = spread.numerator.bit_length() - spread.denominator.bit_length()
        shift = (size - 124) // 2
        scaled = spread / Fraction(4) ** shift
        return float(math.isqrt(scaled.numerator // scaled.denominator) * Fraction(2) ** shift)
