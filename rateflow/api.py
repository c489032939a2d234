"""Session-level API: the engine's operators bundled the way an application uses them.

The classes hold DataFrames (persisted where they are reused) and return DataFrames;
nothing is collected. Requests for many users, many keyword lists or many lookups go
in as one DataFrame and are answered by one plan.

    spark = build_session()
    items = load_items(spark, "hdfs:///data/items")           # id|"title"|"tag|tag"
    ratings = load_ratings(spark, "hdfs:///data/ratings")     # user|item|rating|ts
    an = Analytics(ratings, items)
    an.top_item_per_year().show()
    avg = Averages(spark, ratings, items)
    avg.update(load_deltas(spark, "hdfs:///data/deltas"))
    avg.keyword_average(["Comedy"]).show()
    rec = Recommender(spark, LSHIndex(items), ratings)
    rec.recommend_baseline(rec.requests([(16, ["Action", "Sci-Fi"])]), k=3).show()
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.functions.hashing import DEFAULT_SEEDS
from rateflow.operators import analytics as A
from rateflow.operators import baseline as B
from rateflow.operators import incremental as I
from rateflow.operators import lsh as L
from rateflow.operators import recommend as R
from rateflow.operators import stats as S
from rateflow.schemas import REQUESTS, REQUESTS_WITH_K
from rateflow.session import ScratchScope, checkpoint_dir
from rateflow.sources.text import read_deltas_text, read_items_text, read_ratings_text

_LEVEL = StorageLevel.MEMORY_AND_DISK


def load_items(spark: SparkSession, path: str, permissive: bool = False) -> DataFrame:
    return read_items_text(spark, path, permissive)


def load_ratings(spark: SparkSession, path: str, permissive: bool = False) -> DataFrame:
    return read_ratings_text(spark, path, permissive)


def load_deltas(spark: SparkSession, path: str, permissive: bool = False) -> DataFrame:
    return read_deltas_text(spark, path, permissive)


class Analytics:
    """Per-year and per-tag analytics. The (year, item, count) table and the
    de-duplicated items are persisted, as all yearly answers derive from them."""

    def __init__(self, ratings: DataFrame, items: DataFrame):
        self.items = A.dedup_items(items).persist(_LEVEL)
        self.counts = A.rating_counts_by_year_item(ratings).persist(_LEVEL)

    def items_rated_per_year(self) -> DataFrame:
        return A.items_counted_per_year(self.counts)

    def _winners(self) -> DataFrame:
        return A.year_winners(self.counts, self.items)

    def top_item_per_year(self) -> DataFrame:
        return self._winners().drop("tags")

    def top_tags_per_year(self) -> DataFrame:
        return self._winners().drop("title")

    def tag_years_won(self) -> DataFrame:
        return A.years_won_by_tag(self._winners())

    def least_most_tag(self) -> DataFrame:
        return A.least_and_most(self.tag_years_won())

    @staticmethod
    def items_with_all_tags(items: DataFrame, tags: Iterable[str]) -> DataFrame:
        return A.items_with_all_tags(items, tags).select("title")

    @staticmethod
    def items_with_any_tag(items: DataFrame, tags: Iterable[str]) -> DataFrame:
        return A.items_with_any_tag(items, tags).select("title")

    def unpersist(self) -> None:
        self.items.unpersist()
        self.counts.unpersist()


class Averages:
    """Average rating per item, maintained under deltas (see
    ``incremental.MaintainedAverages`` for how the state is stored). With ``keyword_index`` many
    keyword lists are answered from a maintained index instead of the state."""

    def __init__(self, spark: SparkSession, ratings: DataFrame, items: DataFrame, keyword_index: bool = False):
        self._m = I.MaintainedAverages(spark, S.item_stats(ratings, items))
        self.index = S.KeywordIndex(spark, self._m.state) if keyword_index else None
        if self.index:
            self._m.listeners.append(self.index)

    @property
    def state(self) -> DataFrame:
        return self._m.state

    def close(self) -> None:
        """Delete the stored state and index."""
        self._m.remove()
        if self.index:
            self.index.remove()

    def result(self) -> DataFrame:
        """(item_id, title, avg)."""
        return S.title_averages(self.state)

    def keyword_average(self, keywords: Iterable[str], rated_only: bool = False) -> DataFrame:
        return S.keyword_average(self.state, keywords, rated_only)

    def keyword_averages(self, queries: DataFrame, rated_only: bool = False) -> DataFrame:
        if self.index:
            return self.index.averages(queries, rated_only)
        return S.keyword_averages(self.state, queries, rated_only)

    def update(self, deltas: DataFrame) -> DataFrame:
        return self._m.update(deltas)


class LSHIndex:
    """MinHash buckets of the items' tag lists, in long form (persisted)."""

    def __init__(self, items: DataFrame, seeds: Sequence[int] = DEFAULT_SEEDS):
        self.seeds = tuple(seeds)
        self.index = L.lsh_index(items, self.seeds).persist(_LEVEL)

    def buckets(self) -> DataFrame:
        return self.index

    def bucket_sizes(self) -> DataFrame:
        return L.bucket_sizes(self.index, self.seeds)

    def hash(self, queries: DataFrame, tags_col: str = "tags") -> DataFrame:
        return L.with_signature(queries, tags_col, self.seeds)

    def lookup(self, queries: DataFrame, tags_col: str = "tags", keep_unmatched: bool = True) -> DataFrame:
        return L.lsh_lookup(self.index, queries, tags_col, self.seeds, keep_unmatched)

    def unpersist(self) -> None:
        self.index.unpersist()


def requests_in_memory(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """``[(user_id, tags), ...]`` or ``[(user_id, tags, k), ...]`` -> (query_id, user_id, tags[, k])."""
    data = [(i, int(r[0]), list(r[1]), *(int(k) for k in r[2:])) for i, r in enumerate(rows)]
    own_k = bool(data) and len(data[0]) == 4
    return spark.createDataFrame(data, REQUESTS_WITH_K if own_k else REQUESTS)


class Recommender:
    """Baseline and ALS recommenders over an LSH index (both trained eagerly).

    It owns the tables that training and recommending store; ``close`` removes them, so results
    must be stored or collected before. The index belongs to the caller."""

    def __init__(self, spark: SparkSession, index: LSHIndex, ratings: DataFrame,
                 als_params: dict | None = None, train_als: bool = True):
        from rateflow.operators.als import factors, fit_als
        checkpoint_dir(spark)
        self._spark = spark
        self.index = index
        self.ratings = ratings.select("user_id", "item_id", "rating").persist(_LEVEL)
        self._scope = ScratchScope(spark)
        with self._scope:
            self.baseline = B.fit_baseline(self.ratings)
            self.als = factors(fit_als(self.ratings, **(als_params or {}))) if train_als else None

    def close(self) -> None:
        self.ratings.unpersist()
        self._scope.release()

    def __enter__(self) -> Recommender:
        return self

    def __exit__(self, *exc) -> None:
        self.close()

    def requests(self, rows: Iterable[tuple]) -> DataFrame:
        """``[(user_id, tags), ...]`` or ``[(user_id, tags, k), ...]`` -> a request DataFrame with
        query ids 0..n-1."""
        return requests_in_memory(self._spark, rows)

    def rated_items(self, users: DataFrame) -> DataFrame:
        return R.rated_items(self.ratings, users)

    def predict_baseline(self, pairs: DataFrame) -> DataFrame:
        return B.baseline_predict(self.baseline, pairs)

    def predict_collaborative(self, pairs: DataFrame) -> DataFrame:
        from rateflow.operators.als import als_predict
        return als_predict(self.als, pairs)

    def recommend_baseline(self, requests: DataFrame, k: int) -> DataFrame:
        with self._scope:
            return R.recommend_baseline(self.index.index, requests, self.ratings, self.baseline, k, self.index.seeds)

    def recommend_collaborative(self, requests: DataFrame, k: int) -> DataFrame:
        with self._scope:
            return R.recommend_als(self.index.index, requests, self.ratings, self.als, k, self.index.seeds)
