"""Scalar formulas of the deviation-based baseline predictor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rating scale used by the baseline formulas.
RATING_MAX = 5.0
RATING_MIN_STEP = 1.0


def _c(x: Column | str | float) -> Column:
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(float(x))


def safe_ratio(num: Column, den: Column) -> Column:
    """IEEE division without ANSI's divide-by-zero error: x/0 is +-Infinity or NaN."""
    return (F.when(den != 0, num / den)
            .when(num > 0, F.lit(float("inf")))
            .when(num < 0, F.lit(float("-inf")))
            .otherwise(F.lit(float("nan"))))


def scale(x: Column | str, r: Column | str) -> Column:
    """``5 - r`` above the reference point, ``r - 1`` below it, 1 at it."""
    x, r = _c(x), _c(r)
    return (F.when(x > r, F.lit(RATING_MAX) - r)
            .when(x < r, r - F.lit(RATING_MIN_STEP))
            .otherwise(F.lit(1.0)))


def normalized_deviation(rating: Column | str, user_avg: Column | str) -> Column:
    rating, user_avg = _c(rating), _c(user_avg)
    return safe_ratio(rating - user_avg, scale(rating, user_avg))


def baseline_prediction(user_avg: Column | str, item_dev: Column | str) -> Column:
    """Unknown user scores from an average of 0.0; unknown item returns the user average."""
    r = F.coalesce(_c(user_avg), F.lit(0.0))
    d = _c(item_dev)
    return F.when(d.isNull(), r).otherwise(r + d * scale(r + d, r))
