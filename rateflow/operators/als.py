"""Collaborative filtering with ``pyspark.ml`` ALS (explicit feedback).

Defaults are the original settings: rank 10, 20 iterations, regularisation 0.1,
seed 0 and 4 user and 4 item blocks. A block is one task per ALS stage; as the random
initialisation depends on the blocking, the number of blocks is a fixed parameter and never
follows the cluster, so the same data and parameters give the same model everywhere. Beyond
BLOCKS_GROW_FROM ratings it grows with the root of their number (``block_count``): neither a
block's ratings nor the copies of a factor (one for each block that needs it) grow in proportion.
ALS needs int ids; they are cast at this edge under ANSI, which fails loudly on an id
outside the int range instead of wrapping. ``dense_ids=True`` numbers the ids first (a
distributed dictionary for users and one for items), which lifts that limit.
With a checkpoint directory on the session, ALS checkpoints its factors every
``checkpoint_interval`` iterations, which bounds lineage, recovery work and the shuffle files of
the iterations since; more blocks write more of them, so it is taken as much oftener.

Each iteration solves the items' factors and then the users', so a fitted model's users satisfy
their regularised least squares given the items: for user u with n ratings
``sum((u.v - r) v) + reg * n * u = 0``. ``normal_residuals`` shows how far a model is from
that, and ``fold_in`` solves the same system for users who rated after the fit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rateflow.operators.joins import per_key_join
from rateflow.session import materialize

# Fixed values of the original collaborative-filtering setup.
ALS_RANK = 10
ALS_MAX_ITER = 20
ALS_REG = 0.1
ALS_SEED = 0
ALS_BLOCKS = 4
# Ratings up to which the number of blocks is the parameter's.
BLOCKS_GROW_FROM = 4_000_000


@dataclass
class DenseALS:
    """A model over numbered ids, with the dictionaries of user and item ids."""

    model: ALSModel
    users: DataFrame
    items: DataFrame


def id_numbers(df: DataFrame, column: str) -> DataFrame:
    """(column, column_number): the distinct ids, numbered from 0 in their order and without gaps,
    so the numbers (and the model's start) don't depend on the layout of the data. Each task
    numbers its range; the table is written once, and the sizes of the ranges before shift them."""
    place = F.monotonically_increasing_id()
    ids = materialize(df.select(column).distinct().orderBy(column).withColumn("place", place), "ids").select(
        column, F.shiftright("place", 33).alias("task"), F.col("place").bitwiseAND(F.lit((1 << 33) - 1)).alias("i"))
    sizes = ids.groupBy("task").agg(F.count(F.lit(1)).alias("n"))  # a row for each task
    before = sizes.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("before"))
    return materialize(ids.join(before, "task").select(column, (F.col("i") + F.col("before")).alias(f"{column}_number")), "id-numbers")


def _int_ids(df: DataFrame) -> DataFrame:
    return df.withColumn("user_id", F.col("user_id").cast("int")) \
             .withColumn("item_id", F.col("item_id").cast("int"))


def block_count(n_ratings: int, least: int = ALS_BLOCKS) -> int:
    """Blocks for so many ratings, ``least`` or more: 12 for 36 million, 30 for 216 million."""
    return math.ceil(least * max(1.0, math.sqrt(n_ratings / BLOCKS_GROW_FROM)))


def fit_als(ratings: DataFrame, rank: int = ALS_RANK, max_iter: int = ALS_MAX_ITER,
            reg: float = ALS_REG, seed: int = ALS_SEED, blocks: int = ALS_BLOCKS,
            checkpoint_interval: int = 10, dense_ids: bool = False) -> ALSModel | DenseALS:
    ratings = ratings.select("user_id", "item_id", "rating")
    if dense_ids:
        # Both dictionaries and the numbered ratings are made from it.
        ratings = materialize(ratings, "als-ratings")
    n_blocks = block_count(ratings.count(), blocks)
    if n_blocks > blocks and checkpoint_interval > 0:
        checkpoint_interval = min(checkpoint_interval, max(2, checkpoint_interval * blocks // n_blocks))
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, seed=seed,
              numUserBlocks=n_blocks, numItemBlocks=n_blocks, implicitPrefs=False,
              userCol="user_id", itemCol="item_id", ratingCol="rating",
              coldStartStrategy="nan", checkpointInterval=checkpoint_interval)
    if not dense_ids:
        return als.fit(_int_ids(ratings))
    users, items = id_numbers(ratings, "user_id"), id_numbers(ratings, "item_id")
    numbered = (per_key_join(per_key_join(ratings, users, "user_id"), items, "item_id")
                .select(F.col("user_id_number").alias("user_id"), F.col("item_id_number").alias("item_id"), "rating"))
    return DenseALS(als.fit(_int_ids(numbered)), users, items)


def als_predict(model: ALSModel | DenseALS | Factors, pairs: DataFrame) -> DataFrame:
    """``pairs(user_id, item_id, ...)`` -> the same rows plus ``prediction`` (double);
    NaN for an id the model has not seen."""
    if isinstance(model, Factors):
        joined = per_key_join(per_key_join(pairs, model.users, "user_id", "left"), model.items, "item_id", "left")
        return joined.withColumn("prediction", F.coalesce(dot("u", "v", model.rank), F.lit(float("nan")))).drop("u", "v")
    if isinstance(model, DenseALS):
        numbered = per_key_join(per_key_join(pairs, model.users, "user_id", "left"), model.items, "item_id", "left")
        renamed = numbered.withColumnsRenamed({"user_id": "_user", "item_id": "_item", "user_id_number": "user_id", "item_id_number": "item_id"})
        # No id has the number -1.
        known = renamed.withColumns({c: F.coalesce(c, F.lit(-1)) for c in ("user_id", "item_id")})
        return als_predict(model.model, known).drop("user_id", "item_id").withColumnsRenamed({"_user": "user_id", "_item": "item_id"})
    out = model.transform(_int_ids(pairs))
    return out.withColumn("user_id", F.col("user_id").cast("bigint")) \
              .withColumn("item_id", F.col("item_id").cast("bigint")) \
              .withColumn("prediction", F.col("prediction").cast("double"))


def dot(a: str, b: str, rank: int) -> Column:
    """Inner product of two factor columns, added up in double precision in order."""
    out = F.lit(0.0)
    for i in range(rank):
        out = out + F.get(a, F.lit(i)).cast("double") * F.get(b, F.lit(i)).cast("double")
    return out


@dataclass
class Factors:
    """(user_id, u) and (item_id, v), materialised; ids are the ratings' own."""

    users: DataFrame
    items: DataFrame
    rank: int


def factors(model: ALSModel | DenseALS) -> Factors:
    inner = model.model if isinstance(model, DenseALS) else model

    def side(table: DataFrame, column: str, name: str, numbers: DataFrame | None) -> DataFrame:
        if numbers is None:
            out = table.select(F.col("id").cast("bigint").alias(column), F.col("features").alias(name))
        else:
            out = table.join(numbers, F.col("id") == F.col(f"{column}_number")).select(column, F.col("features").alias(name))
        return materialize(out, f"{column}-factors")

    dense = isinstance(model, DenseALS)
    return Factors(side(inner.userFactors, "user_id", "u", model.users if dense else None),
                   side(inner.itemFactors, "item_id", "v", model.items if dense else None), inner.rank)


def normal_residuals(f: Factors, ratings: DataFrame, reg: float = ALS_REG) -> DataFrame:
    """(user_id, n_ratings, residual): the largest component of each user's normal equations,
    relative to the sums that it is the difference of. Ratings are shuffled to the factors of
    their items and users and summed in every task first."""
    with_items = per_key_join(ratings.select("user_id", "item_id", "rating"), f.items, "item_id")
    rows = per_key_join(with_items, f.users, "user_id").withColumn("err", dot("u", "v", f.rank) - F.col("rating"))
    v = [F.get("v", F.lit(i)).cast("double") for i in range(f.rank)]
    sums = rows.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_ratings"),
        *(F.sum(F.col("err") * v[i]).alias(f"g{i}") for i in range(f.rank)),
        *(F.sum(F.abs(F.col("rating") * v[i])).alias(f"s{i}") for i in range(f.rank)))
    shrink = F.lit(float(reg)) * F.col("n_ratings")
    parts = [F.abs(F.col(f"g{i}") + shrink * F.get("u", F.lit(i))) / (F.col(f"s{i}") + shrink) for i in range(f.rank)]
    return sums.join(f.users, "user_id").select("user_id", "n_ratings", F.greatest(*parts).alias("residual") if len(parts) > 1 else parts[0].alias("residual"))


def _solve(rank: int, reg: float):
    upper = np.triu_indices(rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, batch.num_columns)]
            n, sums = columns[0], np.column_stack(columns[1:]) if batch.num_rows else np.zeros((0, len(columns) - 1))
            gram = np.zeros((batch.num_rows, rank, rank))
            gram[:, upper[0], upper[1]] = sums[:, rank:]
            gram[:, upper[1], upper[0]] = sums[:, rank:]
            gram += (reg * n)[:, None, None] * np.eye(rank)
            # No regularisation and too few ratings: the least solution of a singular system.
            u = np.linalg.solve(gram, sums[:, :rank, None])[..., 0] if reg > 0 else np.einsum("nij,nj->ni", np.linalg.pinv(gram, hermitian=True), sums[:, :rank])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(u.astype(np.float32)), pa.list_(pa.float32()))], names=["user_id", "n_ratings", "u"])
    return run


def fold_in(f: Factors, ratings: DataFrame, reg: float = ALS_REG) -> DataFrame:
    """(user_id, n_ratings, u): the factors that the model would give the users of these ratings
    with its items held fixed. Ratings of items that the model doesn't know don't count; users
    with none that count have no row.

    Gram matrices are sums, so they are aggregated in every task and one row per user is
    shuffled; the small systems are solved many at a time in Arrow batches."""
    rows = per_key_join(ratings.select("user_id", "item_id", "rating"), f.items, "item_id")
    v = [F.get("v", F.lit(i)).cast("double") for i in range(f.rank)]
    sums = rows.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(F.col("rating") * v[i]).alias(f"b{i}") for i in range(f.rank)),
        *(F.sum(v[i] * v[j]).alias(f"a{i}_{j}") for i in range(f.rank) for j in range(i, f.rank)))
    return sums.mapInArrow(_solve(f.rank, float(reg)), "user_id bigint, n_ratings bigint, u array<float>")
