"""Top-K recommendation for many requests in one plan.

A request is ``(query_id, user_id, tags)`` and may have its own ``k``. Its candidates are the items of the LSH
bucket of ``tags`` that the user has not rated; they are scored by a predictor and the
K best are kept per request (prediction descending, ties by item id; NaN scores last).

Plan shape: request signature -> equi-join with the long-form index -> anti-join with
the user's ratings -> key joins with the predictor tables -> per-request row_number
with a literal K. Spark plans the latter as a partial WindowGroupLimit before the
shuffle, so a request that hits a huge bucket is cut to K rows per task before any
exchange; no job runs per candidate and nothing goes through the driver.

The baseline scorer is monotone in the item deviation for users whose average lies in
[1, 5], so by default it scores only a bounded head of each bucket and falls back to
the full bucket exactly where the head cannot decide (see ``_pruned_top_k``). ALS scores of a
bucket are computed as matrix products instead, and only a request's best rows of a part of
the bucket become rows of a table (see ``_als_blocked``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateflow.functions.hashing import DEFAULT_SEEDS, signature_names
from rateflow.functions.scoring import baseline_prediction
from rateflow.operators.als import DenseALS, Factors, dot, factors
from rateflow.operators.baseline import BaselineModel
from rateflow.operators import lsh as L
from rateflow.operators.joins import per_key_join
from rateflow.operators.lsh import lsh_lookup
from rateflow.session import materialize

# Default of the ``decimals`` arguments: predictions are ranked after rounding to so many
# decimals, so that ties are decided by item id, independent of summation order.
RANK_DECIMALS = 6


def rated_items(ratings: DataFrame, users: DataFrame) -> DataFrame:
    """(user_id, item_id) of every rating by the given users; duplicates kept, an
    unknown user has no rows."""
    return ratings.select("user_id", "item_id").join(users.select("user_id"), "user_id", "left_semi")


def unseen_pairs(pairs: DataFrame, ratings: DataFrame) -> DataFrame:
    """The given (user_id, item_id, ...) pairs that the user has not rated."""
    # distinct() pre-aggregates repeated ratings in every task; its output is already
    # hash-partitioned on the join keys, so the anti-join adds no shuffle.
    return pairs.join(ratings.select("user_id", "item_id").distinct(), ["user_id", "item_id"], "left_anti")


def unseen_candidates(index: DataFrame, requests: DataFrame, ratings: DataFrame,
                      seeds: Sequence[int] = DEFAULT_SEEDS) -> DataFrame:
    """(query_id, user_id, item_id): bucket members of the request's tags not yet
    rated by the user. A request whose tags match no bucket has no candidates."""
    cands = lsh_lookup(index, requests.select("query_id", "user_id", "tags"), "tags", seeds,
                       keep_unmatched=False).select("query_id", "user_id", "item_id")
    return unseen_pairs(cands, ratings)


def top_k(scored: DataFrame, k: int, score_col: str = "prediction",
          group_col: str = "query_id", decimals: int = RANK_DECIMALS) -> DataFrame:
    """Keep the ``k`` best rows per group with a ``rank`` column (1 = best). Rows with a column
    ``k`` of their own keep as many as it says, of ``k`` at most."""
    s = F.round(F.col(score_col), decimals)
    w = Window.partitionBy(group_col).orderBy(
        F.when(F.isnan(s) | s.isNull(), 1).otherwise(0), s.desc(), F.col("item_id").asc())
    best = (scored.withColumn(score_col, s).withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= F.lit(int(k))))
    return best.where(F.col("rank") <= F.col("k")) if "k" in scored.columns else best


def recommend_baseline(index: DataFrame, requests: DataFrame, ratings: DataFrame,
                       model: BaselineModel, k: int, seeds: Sequence[int] = DEFAULT_SEEDS,
                       strategy: str = "pruned", head_size: int | None = None,
                       decimals: int = RANK_DECIMALS) -> DataFrame:
    """(query_id, user_id, item_id, prediction, rank). Requests may have a column ``k`` of
    their own; the argument is then the largest that counts.

    ``strategy="full"`` scores every unseen member of the request's bucket.
    ``strategy="pruned"`` gives the same rows while scoring at most ``head_size`` items
    for almost every request; see ``_pruned_top_k``.

    The user average is attached to each request and the item deviation to each index
    row *before* candidates are expanded. The candidate table therefore never joins a
    per-user or per-item table, whatever the skew of users or items among the
    candidates. Its only large joins are the signature join and the anti-join with the
    ratings; the first splits large buckets itself, AQE can split the second.
    """
    cols = ["query_id", "user_id", "item_id", "prediction", "rank"]
    sig = signature_names(seeds)
    own = ["k"] if "k" in requests.columns else []
    q = L.with_signature(requests.select("query_id", "user_id", "tags", *own), "tags", seeds)
    q = per_key_join(q, model.user_avg.select("user_id", "user_avg"), "user_id", "left")
    # Read several times below, and hashing the tags costs most.
    index = materialize(index.select(*sig, "item_id"), "baseline-index")
    seen = ratings.select("user_id", "item_id").distinct()
    if strategy == "full":
        return top_k(_scored(q, _index_with_dev(index, model, sig), seen, seeds), k, decimals=decimals).select(*cols)
    if strategy == "pruned":
        q = materialize(q.drop("tags"), "requests")
        # Three branches leave out what was rated: only pairs of users who ask are kept for them.
        seen = materialize(seen.join(q.select("user_id").distinct(), "user_id", "left_semi"), "rated-pairs")
        return _pruned_top_k(index, q, seen, model, k, seeds,
                             head_size or max(64, 4 * int(k)), decimals).select(*cols)
    raise ValueError(f"unknown strategy: {strategy}")


def _index_with_dev(index: DataFrame, model: BaselineModel, sig: list[str]) -> DataFrame:
    """(sig.., item_id, item_dev): both sides hold one row per item."""
    return index.select(*sig, "item_id").join(
        model.item_dev.select("item_id", "item_dev"), "item_id", "left")


def _scored(q: DataFrame, idx_dev: DataFrame, seen: DataFrame, seeds: Sequence[int]) -> DataFrame:
    """Unseen bucket members of each request, scored: (query_id, user_id, item_id, prediction)."""
    own = ["k"] if "k" in q.columns else []
    return (L.signature_join(q, idx_dev, seeds)
            .join(seen, ["user_id", "item_id"], "left_anti")
            .select("query_id", "user_id", "item_id", *own,
                    baseline_prediction("user_avg", "item_dev").alias("prediction")))


def bucket_heads(index: DataFrame, model: BaselineModel, head_size: int,
                 seeds: Sequence[int] = DEFAULT_SEEDS) -> DataFrame:
    """Per bucket its ``head_size`` items of largest deviation (ties: smaller item id):
    (sig.., item_id, item_dev, d, pos). ``d`` is the deviation with unrated items at
    0.0, which gives them the same prediction as the formula's NULL case.

    A partial WindowGroupLimit keeps at most ``head_size`` rows per bucket in every
    task before the shuffle, so a bucket holding a large share of the items never
    reaches one task whole.
    """
    sig = signature_names(seeds)
    w = Window.partitionBy(*sig).orderBy(F.col("d").desc(), F.col("item_id").asc())
    return (_index_with_dev(index, model, sig)
            .withColumn("d", F.coalesce(F.col("item_dev"), F.lit(0.0)))
            .withColumn("pos", F.row_number().over(w))
            .where(F.col("pos") <= F.lit(int(head_size))))


def class_heads(index: DataFrame, model: BaselineModel, classes: DataFrame, head_size: int,
                seeds: Sequence[int], decimals: int) -> DataFrame:
    """(sig.., r, item_id, prediction): the ``head_size`` best items of a bucket for each of the
    given (sig.., r), where r is the average that a class of requests predicts from."""
    sig = signature_names(seeds)
    w = Window.partitionBy(*sig, "r").orderBy(F.when(F.isnan("prediction"), 1).otherwise(0), F.col("prediction").desc(), F.col("item_id").asc())
    return (L.signature_join(classes, _index_with_dev(index, model, sig), seeds)
            .withColumn("prediction", F.round(baseline_prediction("r", "item_dev"), decimals))
            .withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= F.lit(int(head_size)))
            .select(*sig, "r", "item_id", "prediction"))


def _pruned_top_k(index: DataFrame, q: DataFrame, seen: DataFrame, model: BaselineModel, k: int,
                  seeds: Sequence[int], head_size: int, decimals: int) -> DataFrame:
    """Exact top K per request, scoring only bucket heads where they decide.

    ``q`` holds the signed requests with their user average (NULL for unknown users).
    For a user average r in [1, 5] the prediction r + d * scale(r + d, r) never
    decreases as the item deviation d grows (both slopes, 5 - r and r - 1, are >= 0),
    and neither does its rounding. A request is *resolved* by its bucket's head when
    the bucket fits in the head, or when the head's last item predicts (rounded)
    strictly below the K-th best unseen head item. Every item outside the head has a
    deviation no larger than the last one, so it cannot reach the top K, ties
    included. Resolved requests are ranked on their head (at most ``head_size``
    rows each, so the per-request window is bounded).

    Unknown users, who all predict from 0, and averages outside [1, 5] have no such order.
    Their requests collapse to classes of (bucket, average), and each class is ranked once
    (``class_heads``): it costs classes x bucket rows, however many requests it answers. Such a
    request is resolved by K unseen items of its class's head.

    What is left takes the full path: too many seen items in the head and ties at the
    boundary. Tags that match no bucket have no candidates. The union is exact.
    """
    sig = signature_names(seeds)
    # Heads and the ranked requests feed two branches each; a head has a bounded size, so
    # joining many requests to it is a per-key join.
    heads = materialize(bucket_heads(index, model, head_size, seeds), "bucket-heads")
    # One small row per bucket: its size and the deviation of its last head item.
    info = materialize(index.groupBy(*sig).agg(F.count(F.lit(1)).alias("bucket_size"))
                       .join(heads.where(F.col("pos") == F.lit(int(head_size)))
                             .select(*sig, F.col("d").alias("d_last")), sig, "left"), "bucket-info")
    small = F.col("bucket_size") <= F.lit(int(head_size))
    ordered = F.coalesce(F.col("user_avg").between(1.0, 5.0), F.lit(False))

    regular = q.where(ordered).join(info, sig, "inner")
    scored = (regular.join(heads.select(*sig, "item_id", "item_dev"), sig, "inner")
              .join(seen, ["user_id", "item_id"], "left_anti")
              .withColumn("prediction",
                          F.round(baseline_prediction("user_avg", "item_dev"), decimals)))
    others = q.where(~ordered).withColumn("r", F.coalesce("user_avg", F.lit(0.0)))
    classes = materialize(others.select(*sig, "r").distinct(), "request-classes")
    class_head = materialize(class_heads(index, model, classes, head_size, seeds, decimals), "class-heads")
    by_class = (others.join(info, sig, "inner").join(class_head, [*sig, "r"], "inner")
                .join(seen, ["user_id", "item_id"], "left_anti"))
    order = [F.when(F.isnan("prediction"), 1).otherwise(0), F.col("prediction").desc(),
             F.col("item_id").asc()]
    w = Window.partitionBy("query_id").orderBy(*order)
    w_all = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    boundary = F.round(baseline_prediction("user_avg", "d_last"), decimals)
    kth = F.col("kth")
    cols = ["query_id", "user_id", "item_id", "prediction", "rank", *(["k"] if "k" in q.columns else [])]
    by_head = (scored.withColumn("rank", F.row_number().over(w))
               .withColumn("kth", F.nth_value("prediction", int(k)).over(w_all))
               .withColumn("resolved", small | (kth.isNotNull() & ~F.isnan(kth) & (boundary < kth))))
    # A class's head is in the order of the full path: whatever is outside comes after it.
    by_class = (by_class.withColumn("rank", F.row_number().over(w))
                .withColumn("resolved", small | (F.count(F.lit(1)).over(w_all) >= F.lit(int(k)))))
    ranked = materialize(by_head.select(*cols, "resolved").unionByName(by_class.select(*cols, "resolved")), "ranked")
    fast = ranked.where(F.col("resolved") & (F.col("rank") <= F.lit(int(k))))

    done = ranked.where(F.col("resolved") & (F.col("rank") == 1)).select("query_id")
    rest = q.join(done, "query_id", "left_anti")
    slow = top_k(_scored(rest, _index_with_dev(index, model, sig), seen, seeds), k, decimals=decimals)
    cols = ["query_id", "user_id", "item_id", "prediction", "rank"]
    if "k" in q.columns:
        fast = fast.where(F.col("rank") <= F.col("k"))
    return fast.select(*cols).unionByName(slow.select(*cols))


def recommend_als(index: DataFrame, requests: DataFrame, ratings: DataFrame,
                  model: ALSModel | DenseALS | Factors, k: int, seeds: Sequence[int] = DEFAULT_SEEDS,
                  decimals: int = RANK_DECIMALS, strategy: str = "auto", head_size: int | None = None) -> DataFrame:
    """(query_id, user_id, item_id, prediction, rank) with ALS scores. Requests may have a
    column ``k`` of their own; the argument is then the largest that counts. Users and items that
    the model doesn't know score NaN, which comes last, by item id.

    A user's factors are attached to the request and an item's to the index row before
    candidates are expanded, so the candidates never join a factor table. ``strategy="full"``
    makes a row for every unseen member of the request's bucket; the others give the same rows.
    ``strategy="blocked"``, which is ``"auto"``, scores them all by matrix products, see
    ``_als_blocked``. ``strategy="pruned"`` scores bounded parts of the bucket, see ``_als_pruned``;
    its bounds tell items apart as far as their factors share a direction (what lies beside the
    mean direction is at most PRUNED_BESIDE of the factors' squares), and where they don't, it
    makes nearly as many rows as the full path."""
    f = model if isinstance(model, Factors) else factors(model)
    sig = signature_names(seeds)
    own = ["k"] if "k" in requests.columns else []
    q = L.with_signature(requests.select("query_id", "user_id", "tags", *own), "tags", seeds)
    q = materialize(per_key_join(q.drop("tags"), f.users, "user_id", "left"), "als-requests")
    idx = materialize(per_key_join(index.select(*sig, "item_id"), f.items, "item_id", "left"), "als-index")
    if strategy in ("auto", "blocked"):
        return top_k(_als_blocked(idx, q, ratings, f.rank, k, seeds, decimals), k, decimals=decimals).select(*_RANKED)
    seen = ratings.select("user_id", "item_id").distinct()
    if strategy == "full":
        return top_k(_als_scored(L.signature_join(q, idx, seeds), seen, f.rank), k, decimals=decimals).select(*_RANKED)
    if strategy == "pruned":
        return _als_pruned(idx, q, seen, f.rank, k, seeds, head_size or max(64, 4 * int(k)), decimals)
    raise ValueError(f"unknown strategy: {strategy}")


PRUNED_BESIDE = 0.1


def _beside_mean(f: Factors) -> float:
    """Share of the squared item factors that lies beside the direction of their mean."""
    v = [F.get("v", F.lit(i)).cast("double") for i in range(f.rank)]
    row = f.items.agg(F.avg(dot("v", "v", f.rank)).alias("all"), *(F.avg(x).alias(f"m{i}") for i, x in enumerate(v)),
                      *(F.avg(v[i] * v[j]).alias(f"c{i}_{j}") for i in range(f.rank) for j in range(f.rank))).first()
    if not row["all"]:
        return 1.0
    mean = [row[f"m{i}"] for i in range(f.rank)]
    size = sum(x * x for x in mean)
    along = sum(mean[i] * mean[j] * row[f"c{i}_{j}"] for i in range(f.rank) for j in range(f.rank)) / size if size else 0.0
    return 1 - along / row["all"]


_RANKED = ["query_id", "user_id", "item_id", "prediction", "rank"]


def _als_scored(candidates: DataFrame, seen: DataFrame, rank: int) -> DataFrame:
    own = ["k"] if "k" in candidates.columns else []
    score = F.coalesce(dot("u", "v", rank), F.lit(float("nan")))
    # Factors stay out of the anti-join's shuffle.
    return (candidates.select("query_id", "user_id", "item_id", *own, score.alias("prediction"))
            .join(seen, ["user_id", "item_id"], "left_anti"))


# Requests of one group of ``_als_blocked``; its items are one part of a bucket (L.PART_ITEMS).
GROUP_REQUESTS = 50_000
# Requests and items of one matrix product; a request's first product is a smaller one.
TILE_REQUESTS = 512
TILE_ITEMS = 4096
FIRST_ITEMS = 1024


def _als_blocked(idx: DataFrame, q: DataFrame, ratings: DataFrame, rank: int, k: int, seeds: Sequence[int],
                 decimals: int) -> DataFrame:
    """(query_id, user_id, item_id[, k], prediction): every unseen item that can be one of a
    request's K best, stored.

    A group is one part of a bucket's items and one part of its requests, both of a bounded
    size, so a bucket of any size is spread over tasks. A request goes to each part of its bucket
    with the rated items that lie there. Within a group all scores are computed (``_group_best``),
    and about K rows for each request leave it: rows grow with the requests, not with the pairs."""
    sig = signature_names(seeds)
    own = ["k"] if "k" in q.columns else []
    signed = " and ".join(f"{c} is not null" for c in sig)
    # Only buckets of more than one part: fewer than the rows that fill a part each.
    split = F.broadcast(
        idx.groupBy(*sig).agg(F.ceil(F.count(F.lit(1)) / L.PART_ITEMS).cast("int").alias("_parts"))
        .join(q.groupBy(*sig).agg(F.ceil(F.count(F.lit(1)) / GROUP_REQUESTS).cast("int").alias("_chunks")), sig)
        .where("_parts > 1 or _chunks > 1"))
    parts, chunks = (F.coalesce(c, F.lit(1)) for c in ("_parts", "_chunks"))
    asked = q.where(signed).join(split, sig, "left")
    items = (idx.where(signed).join(split, sig, "left")
             .withColumn("_part", F.pmod(F.xxhash64("item_id"), parts).cast("int")))
    rated = (ratings.select("user_id", "item_id").join(items.select("item_id", *sig, "_part"), "item_id")
             .join(asked.select("user_id", *sig).distinct(), ["user_id", *sig])
             .groupBy("user_id", *sig, "_part").agg(F.collect_set("item_id").alias("rated")))
    group = [*sig, "_part", "_chunk"]
    requests = (asked.withColumn("_chunk", F.pmod(F.xxhash64("query_id", "user_id"), chunks).cast("int"))
                .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
                .join(rated, ["user_id", *sig, "_part"], "left").select(*group, "query_id", "user_id", *own, "u", "rated"))
    members = items.withColumn("_chunk", F.explode(F.sequence(F.lit(0), chunks - 1))).select(*group, "item_id", "v")
    columns = ["query_id", "user_id", *own]
    schema = ", ".join([*(f"{c} {q.schema[c].dataType.simpleString()}" for c in columns), "item_id bigint", "prediction double"])
    best = requests.groupBy(*group).cogroup(members.groupBy(*group)).applyInArrow(_group_best(columns, rank, k, decimals), schema)
    return materialize(best, "als-best")


def _matrix(column: pa.ChunkedArray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have factors, and these as a matrix."""
    rows = column.combine_chunks()
    has = rows.is_valid().to_numpy(zero_copy_only=False).copy()
    m = rows.drop_null().flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, rank)
    fine = np.isfinite(m).all(axis=1)
    has[has] = fine
    return has, m[fine]


class _LeastIds:
    """Ids in order, null first; ``unseen`` gives the first k that are not among the rated ones."""

    def __init__(self, ids: pa.Array):
        self.nulls = ids.null_count
        self.ids, self.times = np.unique(ids.drop_null().to_numpy(zero_copy_only=False), return_counts=True)

    def unseen(self, rated: np.ndarray, k: int) -> list[int | None]:
        some, times = self.ids[:k + len(rated)], self.times[:k + len(rated)]
        if len(rated):
            new = ~np.isin(some, rated)
            some, times = some[new], times[new]
        return ([None] * min(self.nulls, k) + np.repeat(some[:k], np.minimum(times[:k], k)).tolist())[:k]


def _best(r: np.ndarray, p: np.ndarray, u: np.ndarray, v: np.ndarray, ids: np.ndarray, k: int, decimals: int):
    """Of candidates (request r, item p) those that can be among the request's K best, their
    scores, and for each request what its K-th has at least (-inf, if there are fewer).

    Scores are added up as ``dot`` does. Rounding is left to Spark: a score's rounded value lies
    between ``low`` and ``high``, which differ next to a boundary only, and whatever comes after K
    others in any case is dropped."""
    s = np.zeros(len(r))
    for j in range(u.shape[1]):
        s += u[r, j].astype(np.float64) * v[p, j].astype(np.float64)
    x = s * 10.0 ** decimals
    near = 1e-6 + np.abs(x) * 1e-15
    low, high = np.floor(x + 0.5 - near), np.floor(x + 0.5 + near)
    order = np.lexsort((ids[p], -low, r))
    starts = np.flatnonzero(np.r_[True, r[order][1:] != r[order][:-1]]) if len(r) else np.zeros(0, int)
    full = starts[np.diff(np.r_[starts, len(r)]) >= k] + k - 1
    kth = order[full]
    bar, last = np.full(len(u), -np.inf), np.zeros(len(u), ids.dtype)
    bar[r[kth]], last[r[kth]] = low[kth], ids[p[kth]]
    keep = (high > bar[r]) | ((high == bar[r]) & (ids[p] <= last[r]))
    return r[keep], p[keep], s[keep], (bar - 1) / 10.0 ** decimals


def _tiles(u: np.ndarray, v: np.ndarray, norms: np.ndarray, ids: np.ndarray, rated: tuple[np.ndarray, np.ndarray], k: int, decimals: int):
    """The candidates (r, p, score) of some requests among the items v, largest norms first.
    ``rated``: pairs (r, p) to leave out, by p. Products are in single precision, with a margin
    for their error; a request is done where |u| |v| lies below its K-th score."""
    size = np.linalg.norm(u.astype(np.float64), axis=1)
    error = (u.shape[1] + 4) * 1.2e-7 * size * (norms[0] if len(norms) else 0.0)
    floor = np.full(len(u), -np.inf)
    r, p, s = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    at = 0
    while at < len(v):
        to = min(len(v), at + (TILE_ITEMS if at else FIRST_ITEMS))
        live = np.flatnonzero(size * norms[at] * (1 + 1e-6) + error >= floor)
        if not len(live):
            break
        scores = u[live] @ v[at:to].T
        a, b = np.searchsorted(rated[1], [at, to])
        if b > a:
            row = np.full(len(u), -1)
            row[live] = np.arange(len(live))
            row = row[rated[0][a:b]]
            scores[row[row >= 0], rated[1][a:b][row >= 0] - at] = -np.inf
        least = floor[live] - error[live]
        if not at and to >= k:
            least = np.maximum(least, np.partition(scores, to - k, axis=1)[:, to - k] - 2 * error[live] - 2 * 10.0 ** -decimals)
        least = np.nextafter(np.maximum(least, -1e38).astype(np.float32), np.float32(-np.inf))
        new_r, new_p = np.nonzero(scores >= least[:, None])
        if len(new_r):
            r, p, s, floor = _best(np.r_[r, live[new_r]], np.r_[p, new_p + at], u, v, ids, k, decimals)
        at = to
    return r, p, s


def _group_best(columns: list[str], rank: int, k: int, decimals: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For ``_als_blocked``: of a group's requests and items, the rows that can be among a
    request's K best. NaN scores come last, by item id: a request without factors, or with fewer
    than K other items, gets the least ids of those that score NaN."""
    def run(asked: pa.Table, items: pa.Table) -> pa.Table:
        rows, found, scores = [np.zeros(0, int)], [pa.array([], pa.int64())], [np.zeros(0)]
        if asked.num_rows and items.num_rows:
            ids = items.column("item_id").combine_chunks()
            has_v, v = _matrix(items.column("v"), rank)
            has_u, u = _matrix(asked.column("u"), rank)
            lists = asked.column("rated").combine_chunks()
            seen = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(int)) if len(lists) else np.zeros(0, int)
            begins = np.r_[0, ends[:-1]]
            norms = np.linalg.norm(v.astype(np.float64), axis=1)
            order = np.argsort(-norms, kind="stable")
            known = ids.filter(pa.array(has_v)).to_numpy(zero_copy_only=False)[order]
            v, norms = v[order], norms[order]
            by_id = np.argsort(known, kind="stable")
            n_found = np.zeros(asked.num_rows, int)
            with_u = np.flatnonzero(has_u)
            for i in range(0, len(with_u) if len(v) else 0, TILE_REQUESTS):
                some = with_u[i:i + TILE_REQUESTS]
                n = ends[some] - begins[some]
                of = np.repeat(np.arange(len(some)), n)
                what = seen[np.repeat(begins[some] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())]
                first, times = np.searchsorted(known, what, "left", by_id), 0
                times = np.searchsorted(known, what, "right", by_id) - first
                where = by_id[np.repeat(first - np.r_[0, np.cumsum(times)[:-1]][:len(first)], times) + np.arange(times.sum())]
                of, by_place = np.repeat(of, times), np.argsort(where, kind="stable")
                r, p, s = _tiles(u[i:i + TILE_REQUESTS], v, norms, known, (of[by_place], where[by_place]), k, decimals)
                n_found[some] = np.bincount(r, minlength=len(some))
                rows.append(some[r])
                found.append(pa.array(known[p], pa.int64()))
                scores.append(s)
            unknown, every = _LeastIds(ids.filter(pa.array(~has_v))), _LeastIds(ids)
            for i in np.flatnonzero(~has_u | (n_found < k)):
                more = (unknown if has_u[i] else every).unseen(seen[begins[i]:ends[i]], k)
                if more:
                    rows.append(np.full(len(more), i))
                    found.append(pa.array(more, pa.int64()))
                    scores.append(np.full(len(more), np.nan))
        at = pa.array(np.concatenate(rows))
        return pa.table([*(asked.column(c).take(at) for c in columns), pa.concat_arrays(found), pa.array(np.concatenate(scores))],
                        names=[*columns, "item_id", "prediction"])
    return run


def als_blocks(idx: DataFrame, rank: int, head_size: int, seeds: Sequence[int] = DEFAULT_SEEDS) -> tuple[DataFrame, DataFrame]:
    """The index rows (sig.., item_id, v) with their ``block``, and a row for each block (sig..,
    block, n_items, longest, most, least, across).

    Items are ordered within their bucket by the projection p of their factors on the mean
    factor's direction m, and cut into blocks of ``head_size``. A block knows the range of its
    projections (least, most), the largest remainder (across) and the largest norm (longest),
    which bound a user's score in it by Cauchy and Schwarz:
    u.v <= max((u.m) p) + |u - (u.m) m| * across, and u.v <= |u| * longest.

    The order comes from ranges: items go to slices of the projection of about equal size by
    approximate quantiles, places within a slice are counted by a window over a slice of a bucket
    (of a bounded size), and the slices' sizes are added up in a small table."""
    sig = signature_names(seeds)
    mean = idx.where("v is not null").agg(*(F.avg(F.get("v", F.lit(i)).cast("double")).alias(f"m{i}") for i in range(rank))).first()
    mean = [x or 0.0 for x in mean]
    size = sum(x * x for x in mean) ** 0.5 or 1.0
    p = F.lit(0.0)
    for i in range(rank):
        p = p + F.get("v", F.lit(i)).cast("double") * F.lit(mean[i] / size)
    # Items that the model doesn't know come last, with a projection below all others.
    rows = materialize(idx.withColumn("p", F.coalesce(p, F.lit(float("-inf")))).withColumn("norm", F.sqrt(dot("v", "v", rank)))
                       .withColumn("rest", F.sqrt(F.greatest(F.col("norm") * F.col("norm") - p * p, F.lit(0.0)))), "als-items")
    n = rows.count()
    slices = max(1, -(-n // SLICE_ITEMS))
    cuts = sorted(set(rows.where("v is not null").stat.approxQuantile("p", [i / slices for i in range(1, slices)], 0.1 / slices))) if slices > 1 else []
    cut = F.lit(0)
    if cuts:
        found = F.array(*(F.lit(c) for c in reversed(cuts)))
        cut = F.size(F.filter(found, lambda c: c > F.col("p")))
    rows = rows.withColumn("slice", cut)
    before = Window.partitionBy(*sig).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*sig, "slice").count().withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    place = F.row_number().over(Window.partitionBy(*sig, "slice").orderBy(F.col("p").desc(), F.col("item_id").asc())) - 1
    placed = materialize(rows.withColumn("place", place).join(sizes, [*sig, "slice"])
                         .withColumn("block", F.floor((F.col("before") + F.col("place")) / head_size))
                         .select(*sig, "block", "item_id", "v", "p", "norm", "rest"), "als-placed")
    blocks = materialize(placed.groupBy(*sig, "block").agg(
        F.count(F.lit(1)).alias("n_items"), F.max("norm").alias("longest"), F.max("p").alias("most"),
        F.min(F.when(F.col("v").isNotNull(), F.col("p"))).alias("least"), F.max("rest").alias("across"))
        .withColumn("mean", F.array(*(F.lit(x / size) for x in mean))), "als-blocks")
    return placed.select(*sig, "block", "item_id", "v"), blocks


# Items of one slice of the order of all items; a slice of a bucket is sorted by one task.
SLICE_ITEMS = 1_000_000


def _als_pruned(idx: DataFrame, q: DataFrame, seen: DataFrame, rank: int, k: int, seeds: Sequence[int],
                head_size: int, decimals: int) -> DataFrame:
    """Exact top K per request from the blocks of its bucket that can hold one of them.

    The first block of a bucket (its head) is scored for every request that has factors. The K-th
    unseen score there is a floor: every block whose bound lies below it (by more than the
    rounding) is left out, the others are scored as well. A request with fewer unseen items in
    its head has no floor and scores all blocks. Requests without factors score NaN throughout
    and want the smallest unseen ids: they are answered from the bucket's least ids, or, where
    too many of those are seen, from the whole bucket."""
    sig = signature_names(seeds)
    placed, blocks = als_blocks(idx, rank, head_size, seeds)
    own = ["k"] if "k" in q.columns else []
    known = q.where("u is not null")
    first = placed.where("block = 0").drop("block")
    in_head = materialize(_als_scored(known.join(first, sig), seen, rank), "als-heads")
    s = F.round("prediction", decimals)
    floor_ = (in_head.where(~F.isnan("prediction")).withColumn("i", F.row_number().over(Window.partitionBy("query_id").orderBy(s.desc())))
              .where(F.col("i") == F.lit(int(k))).select("query_id", s.alias("floor")))
    asked = materialize(known.join(floor_, "query_id", "left"), "als-asked")
    a = dot("u", "mean", rank)
    norm = F.sqrt(dot("u", "u", rank))
    side = F.sqrt(F.greatest(norm * norm - a * a, F.lit(0.0)))
    slack = F.lit(10.0 ** -decimals) + 1e-9 * norm * F.col("longest")
    bound = F.least(norm * F.col("longest"), F.greatest(a * F.col("most"), a * F.col("least")) + side * F.col("across"))
    # A block of unknown items alone has no bound: its NaN scores come after any floor.
    wanted = F.col("floor").isNull() | (F.col("longest").isNotNull() & (bound + slack >= F.col("floor")))
    more = (asked.join(blocks.where("block > 0"), sig).where(wanted)
            .select("query_id", "user_id", "u", *own, *sig, "block"))
    further = _als_scored(more.join(placed, [*sig, "block"]), seen, rank)
    best = top_k(in_head.unionByName(further), k, decimals=decimals)

    unknown = q.where("u is null")
    w = Window.partitionBy(*sig).orderBy("item_id")
    least = materialize(idx.select(*sig, "item_id", "v").withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= F.lit(int(head_size))).drop("pos"), "least-ids")
    sizes = idx.groupBy(*sig).agg(F.count(F.lit(1)).alias("bucket_size"))
    by_id = materialize(_als_scored(unknown.join(least, sig), seen, rank), "als-unknown")
    enough = by_id.groupBy("query_id").count().where(F.col("count") >= F.lit(int(k))).select("query_id")
    fits = unknown.join(sizes, sig).where(F.col("bucket_size") <= F.lit(int(head_size))).select("query_id")
    done = materialize(enough.unionByName(fits).distinct(), "als-done")
    rest = unknown.join(done, "query_id", "left_anti")
    cold = top_k(by_id.join(done, "query_id", "left_semi").unionByName(_als_scored(L.signature_join(rest, idx, seeds), seen, rank)), k, decimals=decimals)
    return best.select(*_RANKED).unionByName(cold.select(*_RANKED))
