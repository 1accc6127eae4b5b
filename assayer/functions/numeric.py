"""Range arithmetic on columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

Range = tuple[float, float]

UNIT: Range = (0.0, 1.0)
P_VALUE_RANGE: Range = (1e-10, 1.0)


def _check(rng: Range) -> None:
    if not rng[1] > rng[0]:
        raise ValueError(f"range end must exceed its start: {rng}")


def clip(value: Column, rng: Range) -> Column:
    """Bring a value into a closed range; NULL and NaN pass through.

    Spark orders NaN above every number, so it is tested for before `>`.
    """
    low, high = float(rng[0]), float(rng[1])
    return (
        F.when(F.isnan(value), value)
        .when(value > high, F.lit(high))
        .when(value < low, F.lit(low))
        .otherwise(value)
    )


def cap(value: Column, high: float) -> Column:
    """Upper bound only. `least` would turn NULL into the bound, this keeps NULL."""
    return F.when(~F.isnan(value) & (value > float(high)), F.lit(float(high))).otherwise(value)


def rescale(value: Column, current: Range, new: Range) -> Column:
    """Project a value from one range linearly onto another, clipped to the new one."""
    _check(current)
    _check(new)
    c0, c1 = float(current[0]), float(current[1])
    n0, n1 = float(new[0]), float(new[1])
    share = (value.cast("double") - F.lit(c0)) / F.lit(c1 - c0)
    return clip(F.lit(n0) + share * F.lit(n1 - n0), (n0, n1))


def p_value_score(p: Column, rng: Range = P_VALUE_RANGE) -> Column:
    """Score in [0, 1]; the smaller the p-value, the higher the score.

    A p-value of 0 scores 1. A negative or NaN p-value has no score (NULL).
    """
    _check(rng)
    p = p.cast("double")
    low, high = math.log10(rng[0]), math.log10(rng[1])
    # Inside the guard the logarithm is neither NULL nor NaN, so least and
    # greatest clip it while naming it once.
    share = (F.log10(p) - F.lit(low)) / F.lit(high - low)
    clipped = F.least(F.lit(1.0), F.greatest(F.lit(0.0), share))
    return F.when(p == 0.0, F.lit(1.0)).when((p > 0.0) & ~F.isnan(p), F.lit(1.0) - clipped)
