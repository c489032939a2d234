"""Named queries over the driver's tables: one per operator of the engine.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame. Arrays are rendered as
``|``-joined strings and doubles that come from means are rounded to 6 decimals, so
the results compare by value against the DuckDB oracle in ``plans.oracle``.
Every query runs over the whole tables. Only the incremental ones, and the predictions
of later ratings from earlier ones, split the ratings by date.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.functions.hashing import DEFAULT_SEEDS
from rateflow.operators import analytics as A
from rateflow.operators import baseline as B
from rateflow.operators import incremental as I
from rateflow.operators import lsh as L
from rateflow.operators.layout import BucketedRatings, ClusteredRatings
from rateflow.operators import recommend as R
from rateflow.operators import stats as S
from rateflow.session import scratch_path
from rateflow.sources import tables as TB
from rateflow.sources import text as TX
from rateflow.streaming.deltas import stream_apply_deltas

# Fixed parameters of the catalogue's queries.
ALL_TAGS = ["STANDARD", "widget"]
ANY_TAGS = ["LARGE", "anvil"]
KEYWORDS = ["PROMO"]
KEYWORDS_NONE = ["no-such-tag"]
SECOND_DELTA_FROM = "2001-09-01"
TOP_K = 3
DAMAGED_STEP = 7
COLD_USERS = 1_000_000_000
SOLVED_WITHIN = 1e-3
FEED_ROWS = 1_000_000
FEED_FILES = 64
# Requests given in memory, each with a K of its own: (user_id, tags, k).
REQUESTS_IN_MEMORY = [(1 + 37 * i, [tag], 1 + i % 4) for i, tag in enumerate(
    ["PROMO", "STANDARD", "ECONOMY", "LARGE", "MEDIUM", "SMALL", "anvil", "widget"])]
ROUND = 6

Query = Callable[[SparkSession, str], DataFrame]


def _tags_str(col: str = "tags", alias: str | None = None):
    return F.array_join(F.col(col), "|").alias(alias or col)


def _r(col: str, alias: str | None = None):
    return F.round(F.col(col), ROUND).alias(alias or col)


def _state_out(state: DataFrame) -> DataFrame:
    return state.select("item_id", "title", _tags_str(), "n", "s", _r("avg"))


# --- shared inputs -----------------------------------------------------------

def item_state(spark: SparkSession, d: str) -> DataFrame:
    return S.item_stats(TB.ratings_table(spark, d), TB.items_table(spark, d))


def base_state(spark: SparkSession, d: str) -> DataFrame:
    """The state before the deltas; only the incremental queries start from it."""
    return S.item_stats(TB.base_ratings(spark, d), TB.items_table(spark, d))


def recommend_requests(spark: SparkSession, d: str, ratings: DataFrame | None = None,
                       items: DataFrame | None = None) -> DataFrame:
    """One request per user: the tags of the user's latest rated item (latest ship
    date, then largest item id)."""
    ratings = TB.ratings_table(spark, d) if ratings is None else ratings
    items = TB.items_table(spark, d) if items is None else items
    latest = ratings.groupBy("user_id").agg(
        F.max_by(F.col("item_id"), F.struct("ts", "item_id")).alias("item_id"))
    return latest.join(A.dedup_items(items), "item_id").select(
        F.col("user_id").alias("query_id"), "user_id", "tags")


def lookup_queries(spark: SparkSession, d: str) -> DataFrame:
    """One single-tag query per item type."""
    part = TB.table(spark, d, "part")
    return part.select(F.array(F.col("p_type")).alias("tags")).distinct()


def keyword_queries(spark: SparkSession, d: str) -> DataFrame:
    """Every item type alone and with each first word of the item names, and no keyword."""
    part = TB.table(spark, d, "part")
    pairs = part.select(F.array(F.col("p_type"), F.split(F.col("p_name"), " ")[0]).alias("keywords"))
    singles = part.select(F.array(F.col("p_type")).alias("keywords"))
    none = part.select(F.array().cast("array<string>").alias("keywords"))
    q = pairs.union(singles).union(none).distinct()
    return q.select(F.array_join("keywords", ",").alias("query_id"), "keywords")


def delta_pairs(spark: SparkSession, d: str) -> DataFrame:
    return TB.delta_ratings(spark, d).select("user_id", "item_id").distinct()


# --- loaders ------------------------------------------------------------------

def load_items_text(spark, d):
    path = scratch_path(spark, "items-text")
    TX.write_items_text(TB.items_table(spark, d), path)
    return TX.read_items_text(spark, path).select("item_id", "title", _tags_str())


def load_ratings_text(spark, d):
    path = scratch_path(spark, "ratings-text")
    TX.write_ratings_text(TB.ratings_table(spark, d), path)
    return TX.read_ratings_text(spark, path)


def load_delta_text(spark, d):
    path = scratch_path(spark, "delta-text")
    TX.write_deltas_text(TB.delta_ratings(spark, d), path)
    return TX.read_deltas_text(spark, path)


def load_ratings_text_rejected(spark, d):
    """The lines that the permissive reader diverts, from a feed in which the ratings of one
    user in DAMAGED_STEP are damaged."""
    path = scratch_path(spark, "damaged-ratings-text")
    lines = TX.ratings_lines(TB.ratings_table(spark, d), damaged=F.col("user_id") % DAMAGED_STEP == 0)
    lines.write.text(path)
    return TX.rejected_lines(spark, path, "ratings")


def load_ratings_text_diverted(spark, d):
    """Good rows and rejected lines of the damaged feed, from one pass."""
    path = scratch_path(spark, "damaged-ratings-text")
    TX.ratings_lines(TB.ratings_table(spark, d), damaged=F.col("user_id") % DAMAGED_STEP == 0).write.text(path)
    found = TX.divert_lines(spark, path, "ratings")
    nothing = F.lit(None)
    return (found.rows.select("user_id", "item_id", "rating", "ts", nothing.cast("string").alias("line"))
            .unionByName(found.rejected.select(nothing.cast("bigint").alias("user_id"), nothing.cast("bigint").alias("item_id"),
                                               nothing.cast("double").alias("rating"), nothing.cast("bigint").alias("ts"), "line")))


# --- analytics ----------------------------------------------------------------

def items_per_year(spark, d):
    return A.items_rated_per_year(TB.ratings_table(spark, d))


def rating_counts_year_item(spark, d):
    return A.rating_counts_by_year_item(TB.ratings_table(spark, d))


def top_item_per_year(spark, d):
    return A.top_item_per_year(TB.ratings_table(spark, d), TB.items_table(spark, d))


def top_tags_per_year(spark, d):
    out = A.top_tags_per_year(TB.ratings_table(spark, d), TB.items_table(spark, d))
    return out.select("year", "item_id", _tags_str(), "n_ratings")


def tag_years_won(spark, d):
    return A.tag_years_won(TB.ratings_table(spark, d), TB.items_table(spark, d))


def least_most_tag(spark, d):
    return A.least_most_tag(TB.ratings_table(spark, d), TB.items_table(spark, d))


def items_with_all_tags(spark, d):
    return A.items_with_all_tags(TB.items_table(spark, d), ALL_TAGS).select(
        "item_id", "title", _tags_str())


def items_with_all_tags_empty(spark, d):
    return A.items_with_all_tags(TB.items_table(spark, d), []).select(
        "item_id", "title", _tags_str())


def items_with_any_tag(spark, d):
    return A.items_with_any_tag(TB.items_table(spark, d), ANY_TAGS).select(
        "item_id", "title", _tags_str())


# --- averages -----------------------------------------------------------------

def item_stats(spark, d):
    return _state_out(item_state(spark, d))


def title_averages(spark, d):
    return S.title_averages(item_state(spark, d)).select("item_id", "title", _r("avg"))


def title_merged(spark, d):
    return S.title_merged(item_state(spark, d)).select("title", _r("sum_avg"))


def keyword_average(spark, d):
    return S.keyword_average(item_state(spark, d), KEYWORDS).select(_r("keyword_avg"), "n_items")


def keyword_average_none(spark, d):
    return S.keyword_average(item_state(spark, d), KEYWORDS_NONE).select(_r("keyword_avg"), "n_items")


def keyword_average_rated_only(spark, d):
    return S.keyword_average(item_state(spark, d), KEYWORDS, rated_only=True).select(
        _r("keyword_avg"), "n_items")


def keyword_averages(spark, d):
    return S.keyword_averages(item_state(spark, d), keyword_queries(spark, d)).select(
        "query_id", _r("keyword_avg"), "n_items")


# --- incremental --------------------------------------------------------------

def delta_fold(spark, d):
    return I.delta_fold(TB.delta_ratings(spark, d))


def apply_delta(spark, d):
    return _state_out(I.apply_delta(base_state(spark, d), TB.delta_ratings(spark, d)))


def apply_delta_twice(spark, d):
    first = TB.delta_ratings(spark, d, until=SECOND_DELTA_FROM)
    second = TB.delta_ratings(spark, d, since=SECOND_DELTA_FROM)
    return _state_out(I.apply_delta(I.apply_delta(base_state(spark, d), first), second))


def keyword_average_after_delta(spark, d):
    state = I.apply_delta(base_state(spark, d), TB.delta_ratings(spark, d))
    return S.keyword_average(state, KEYWORDS).select(_r("keyword_avg"), "n_items")


def apply_delta_stored(spark, d):
    """The deltas as two updates of a stored state, which rewrite the parts that they touch."""
    kept = I.MaintainedAverages(spark, base_state(spark, d))
    kept.update(TB.delta_ratings(spark, d, until=SECOND_DELTA_FROM))
    return _state_out(kept.update(TB.delta_ratings(spark, d, since=SECOND_DELTA_FROM)))


def keyword_averages_after_delta(spark, d):
    """All keyword queries, from an index that follows the deltas."""
    kept = I.MaintainedAverages(spark, base_state(spark, d))
    index = S.KeywordIndex(spark, kept.state)
    kept.listeners.append(index)
    kept.update(TB.delta_ratings(spark, d))
    return index.averages(keyword_queries(spark, d)).select("query_id", _r("keyword_avg"), "n_items")


def apply_delta_stream(spark, d):
    """The delta feed as Parquet files of FEED_ROWS rows at most, streamed in micro-batches."""
    feed = scratch_path(spark, "delta-feed")
    TB.delta_ratings(spark, d).write.option("maxRecordsPerFile", FEED_ROWS).parquet(feed)
    state = stream_apply_deltas(spark, base_state(spark, d), feed, max_files_per_trigger=FEED_FILES)
    return _state_out(state)


# --- LSH ----------------------------------------------------------------------

def tag_hash(spark, d):
    return L.tag_hashes(TB.items_table(spark, d), DEFAULT_SEEDS)


def item_signatures(spark, d):
    return L.lsh_index(TB.items_table(spark, d)).select("item_id", "sig_0", "sig_1")


def lsh_buckets(spark, d):
    return L.bucket_sizes(L.lsh_index(TB.items_table(spark, d)))


def _lookup(spark, d, keep):
    idx = L.lsh_index(TB.items_table(spark, d))
    out = L.lsh_lookup(idx, lookup_queries(spark, d), keep_unmatched=keep)
    return out.select(_tags_str("tags", "query_tags"), "sig_0", "sig_1", "item_id", "item_title")


def lsh_lookup(spark, d):
    return _lookup(spark, d, keep=False)


def lsh_lookup_keep_unmatched(spark, d):
    return _lookup(spark, d, keep=True)


# --- baseline predictor -------------------------------------------------------

def user_averages(spark, d):
    return B.user_averages(TB.ratings_table(spark, d)).select("user_id", _r("user_avg"), "n_ratings")


def ratings_with_user_avg(spark, d):
    return B.ratings_with_user_avg(TB.ratings_table(spark, d)).select(
        "user_id", "item_id", "rating", "ts", _r("user_avg"))


def normalized_deviation(spark, d):
    return B.normalized_deviations(TB.ratings_table(spark, d)).select(
        "user_id", "item_id", "rating", _r("ndev"))


def item_deviation(spark, d):
    return B.item_deviation(TB.ratings_table(spark, d)).select("item_id", _r("item_dev"), "n_ratings")


def baseline_predict(spark, d):
    """Trained on the base period, asked for every (user, item) of the deltas: users
    and items absent from the base are the cold-start rows."""
    model = B.fit_baseline(TB.base_ratings(spark, d))
    return B.baseline_predict(model, delta_pairs(spark, d)).select(
        "user_id", "item_id", _r("prediction"))


def ratings_with_user_avg_stored(spark, d):
    """Each rating with its user's average, from ratings that are stored in buckets by user."""
    stored = BucketedRatings(spark, TB.ratings_table(spark, d))
    averages = stored.per_key(F.avg("rating").alias("user_avg"))
    return stored.join(averages).select("user_id", "item_id", "rating", "ts", _r("user_avg"))


# --- recommendation -----------------------------------------------------------

def rated_items_of_user(spark, d):
    """The point lookup for every customer."""
    users = TB.table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    return R.rated_items(TB.ratings_table(spark, d), users)


def rated_items_lookup(spark, d):
    """The rated items of the users with requests in memory, from the clustered ratings."""
    stored = ClusteredRatings(spark, TB.ratings_table(spark, d))
    return stored.lookup(u for u, _, _ in REQUESTS_IN_MEMORY).select("user_id", "item_id", "rating", "ts")


def unseen_candidates(spark, d):
    """Of the delta's (user, item) pairs, those that the user had not rated before."""
    return R.unseen_pairs(delta_pairs(spark, d), TB.base_ratings(spark, d))


def recommend_baseline(spark, d):
    ratings, items = TB.ratings_table(spark, d), TB.items_table(spark, d)
    model = B.fit_baseline(ratings)
    return R.recommend_baseline(L.lsh_index(items), recommend_requests(spark, d, ratings, items), ratings,
                                model, TOP_K)


def recommend_baseline_own_k(spark, d):
    from rateflow.api import requests_in_memory
    ratings, items = TB.ratings_table(spark, d), TB.items_table(spark, d)
    requests = requests_in_memory(spark, REQUESTS_IN_MEMORY)
    most = max(k for _, _, k in REQUESTS_IN_MEMORY)
    return R.recommend_baseline(L.lsh_index(items), requests, ratings, B.fit_baseline(ratings), most)


def recommend_baseline_cold(spark, d):
    """Every user's request, and the same again from a user without ratings."""
    ratings, items = TB.ratings_table(spark, d), TB.items_table(spark, d)
    known = recommend_requests(spark, d, ratings, items)
    cold = known.select((-1 - F.col("query_id")).alias("query_id"), (F.col("user_id") + COLD_USERS).alias("user_id"), "tags")
    return R.recommend_baseline(L.lsh_index(items), known.unionByName(cold), ratings, B.fit_baseline(ratings), TOP_K)


def als_predict(spark, d):
    from rateflow.operators.als import als_predict as predict, fit_als
    model = fit_als(TB.base_ratings(spark, d), dense_ids=True)
    return predict(model, delta_pairs(spark, d)).select("user_id", "item_id", "prediction")


def als_normal_equations(spark, d):
    """Whether each user's factors solve the user's regularised least squares."""
    from rateflow.operators.als import factors, fit_als, normal_residuals
    ratings = TB.ratings_table(spark, d)
    found = normal_residuals(factors(fit_als(ratings, dense_ids=True)), ratings)
    return found.select("user_id", "n_ratings", (F.col("residual") < SOLVED_WITHIN).alias("solved"))


def als_fold_in(spark, d):
    """Users of the deltas, given factors by their delta ratings under the model of the base."""
    from rateflow.operators.als import factors, fit_als, fold_in
    f = factors(fit_als(TB.base_ratings(spark, d), dense_ids=True))
    return fold_in(f, TB.delta_ratings(spark, d)).select("user_id", "n_ratings", F.size("u").alias("rank"))


def recommender_fit(spark, d):
    """Both models of the session API's recommender, trained together: how many items each
    recommends for every request."""
    from rateflow.api import LSHIndex, Recommender
    items = TB.items_table(spark, d)
    rec = Recommender(spark, LSHIndex(items), TB.ratings_table(spark, d), als_params={"dense_ids": True})
    requests = recommend_requests(spark, d)
    both = (rec.recommend_baseline(requests, TOP_K).select("query_id", F.lit(1).alias("b"), F.lit(0).alias("c"))
            .unionByName(rec.recommend_collaborative(requests, TOP_K).select("query_id", F.lit(0).alias("b"), F.lit(1).alias("c"))))
    return both.groupBy("query_id").agg(F.sum("b").alias("n_baseline"), F.sum("c").alias("n_collaborative"))


def recommend_als(spark, d):
    from rateflow.operators.als import fit_als
    ratings, items = TB.ratings_table(spark, d), TB.items_table(spark, d)
    model = fit_als(ratings, dense_ids=True)
    return R.recommend_als(L.lsh_index(items), recommend_requests(spark, d, ratings, items), ratings,
                           model, TOP_K)


def als_coldstart(spark, d):
    """Which delta pairs the model has a prediction for: user and item are both known."""
    return als_predict(spark, d).select(
        "user_id", "item_id", (F.col("prediction").isNotNull() & ~F.isnan("prediction")).alias("has_prediction"))


def recommend_als_shape(spark, d):
    """What must hold for every request's ALS recommendations, whatever the scores: how many
    there are, that none is rated or outside the bucket, and that ranks are 1 to n."""
    ratings, index = TB.ratings_table(spark, d), L.lsh_index(TB.items_table(spark, d))
    requests = recommend_requests(spark, d, ratings)
    sig = L.signature_names(DEFAULT_SEEDS)
    seen = ratings.select("user_id", "item_id").distinct().withColumn("seen", F.lit(1))
    asked = L.with_signature(requests, "tags").select("query_id", *(F.col(c).alias(f"q_{c}") for c in sig))
    inside = F.lit(True)
    for c in sig:
        inside = inside & (F.col(c) == F.col(f"q_{c}"))
    got = (recommend_als(spark, d).join(seen, ["user_id", "item_id"], "left").join(asked, "query_id")
           .join(index.select("item_id", *sig), "item_id"))
    return got.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.coalesce(F.sum("seen"), F.lit(0)).cast("bigint").alias("n_seen"),
        F.sum(F.when(inside, 0).otherwise(1)).cast("bigint").alias("n_outside"), F.sum("rank").cast("bigint").alias("rank_sum"))


QUERIES: dict[str, Query] = {
    "load_items_text": load_items_text,
    "load_ratings_text": load_ratings_text,
    "load_delta_text": load_delta_text,
    "load_ratings_text_rejected": load_ratings_text_rejected,
    "load_ratings_text_diverted": load_ratings_text_diverted,
    "items_per_year": items_per_year,
    "rating_counts_year_item": rating_counts_year_item,
    "top_item_per_year": top_item_per_year,
    "top_tags_per_year": top_tags_per_year,
    "tag_years_won": tag_years_won,
    "least_most_tag": least_most_tag,
    "items_with_all_tags": items_with_all_tags,
    "items_with_all_tags_empty": items_with_all_tags_empty,
    "items_with_any_tag": items_with_any_tag,
    "item_stats": item_stats,
    "title_averages": title_averages,
    "title_merged": title_merged,
    "keyword_average": keyword_average,
    "keyword_average_none": keyword_average_none,
    "keyword_average_rated_only": keyword_average_rated_only,
    "keyword_averages": keyword_averages,
    "delta_fold": delta_fold,
    "apply_delta": apply_delta,
    "apply_delta_twice": apply_delta_twice,
    "keyword_average_after_delta": keyword_average_after_delta,
    "apply_delta_stored": apply_delta_stored,
    "keyword_averages_after_delta": keyword_averages_after_delta,
    "apply_delta_stream": apply_delta_stream,
    "tag_hash": tag_hash,
    "item_signatures": item_signatures,
    "lsh_buckets": lsh_buckets,
    "lsh_lookup": lsh_lookup,
    "lsh_lookup_keep_unmatched": lsh_lookup_keep_unmatched,
    "user_averages": user_averages,
    "ratings_with_user_avg": ratings_with_user_avg,
    "ratings_with_user_avg_stored": ratings_with_user_avg_stored,
    "normalized_deviation": normalized_deviation,
    "item_deviation": item_deviation,
    "baseline_predict": baseline_predict,
    "rated_items_of_user": rated_items_of_user,
    "rated_items_lookup": rated_items_lookup,
    "unseen_candidates": unseen_candidates,
    "recommend_baseline": recommend_baseline,
    "recommend_baseline_own_k": recommend_baseline_own_k,
    "recommend_baseline_cold": recommend_baseline_cold,
    "als_predict": als_predict,
    "als_normal_equations": als_normal_equations,
    "als_fold_in": als_fold_in,
    "recommender_fit": recommender_fit,
    "als_coldstart": als_coldstart,
    "recommend_als": recommend_als,
    "recommend_als_shape": recommend_als_shape,
}
