"""Deviation-based baseline predictor.

  user_avg(u)    = mean rating of u
  ndev(u, i)     = (r - user_avg) / scale(r, user_avg)
  item_dev(i)    = mean ndev over the item's ratings
  predict(u, i)  = user_avg + item_dev * scale(user_avg + item_dev, user_avg)

An unknown user predicts from an average of 0.0; an unknown item returns the user
average. Every step is an aggregate or a key join. The per-rating user average is a
join with the per-user table (not a window). Per-key tables are materialised before they
are joined, so a key that owns a large share of the rows is split by AQE instead of landing
in one task (``joins.per_key_join``), and the ratings are read once for each of the two.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.functions.scoring import baseline_prediction, normalized_deviation
from rateflow.operators.joins import per_key_join
from rateflow.session import materialize


def user_averages(ratings: DataFrame) -> DataFrame:
    """(user_id, user_avg, n_ratings)."""
    return ratings.groupBy("user_id").agg(F.avg("rating").alias("user_avg"),
                                          F.count(F.lit(1)).alias("n_ratings"))


def ratings_with_user_avg(ratings: DataFrame, user_avg: DataFrame | None = None) -> DataFrame:
    """Each rating with its user's average. ``user_avg``: a materialised table."""
    ua = materialize(user_averages(ratings), "user-averages") if user_avg is None else user_avg
    return per_key_join(ratings, ua.select("user_id", "user_avg"), "user_id")


def normalized_deviations(ratings: DataFrame, user_avg: DataFrame | None = None) -> DataFrame:
    """(user_id, item_id, rating, user_avg, ndev) per rating."""
    rwa = ratings_with_user_avg(ratings, user_avg)
    return rwa.select("user_id", "item_id", "rating", "user_avg",
                      normalized_deviation("rating", "user_avg").alias("ndev"))


def item_deviation(ratings: DataFrame, user_avg: DataFrame | None = None) -> DataFrame:
    """(item_id, item_dev, n_ratings)."""
    nd = normalized_deviations(ratings, user_avg)
    return nd.groupBy("item_id").agg(F.avg("ndev").alias("item_dev"),
                                     F.count(F.lit(1)).alias("n_ratings"))


@dataclass
class BaselineModel:
    """Both tables are materialised in the shared folder."""

    user_avg: DataFrame   # (user_id, user_avg, n_ratings)
    item_dev: DataFrame   # (item_id, item_dev, n_ratings)


def fit_baseline(ratings: DataFrame) -> BaselineModel:
    ua = materialize(user_averages(ratings), "user-averages")
    return BaselineModel(user_avg=ua, item_dev=materialize(item_deviation(ratings, ua), "item-deviations"))


def baseline_predict(model: BaselineModel, pairs: DataFrame) -> DataFrame:
    """``pairs(user_id, item_id, ...)`` -> the same rows plus ``prediction``."""
    j = per_key_join(pairs, model.user_avg.select("user_id", "user_avg"), "user_id", "left")
    j = per_key_join(j, model.item_dev.select("item_id", "item_dev"), "item_id", "left")
    return j.withColumn("prediction", baseline_prediction("user_avg", "item_dev")) \
            .drop("user_avg", "item_dev")
