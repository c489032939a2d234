"""Average rating per item and keyword averages over them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.functions.tags import has_all_tags
from rateflow.operators.analytics import dedup_items
from rateflow.session import remove_path, scratch_path


def item_stats(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Aggregate state per item: (item_id, title, tags, n, s, avg).

    Unrated items have ``n = 0, s = 0.0, avg = 0.0``; ratings of unknown items are
    dropped. The rating aggregate is partial per task before the shuffle, then
    joined to the items by key.
    """
    agg = ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("s"))
    joined = dedup_items(items).join(agg, "item_id", "left")
    n = F.coalesce(F.col("n"), F.lit(0).cast("bigint"))
    s = F.coalesce(F.col("s"), F.lit(0.0))
    return joined.select(
        "item_id", "title", "tags", n.alias("n"), s.alias("s"),
        F.when(n > 0, s / n).otherwise(F.lit(0.0)).alias("avg"))


def title_averages(state: DataFrame) -> DataFrame:
    """(item_id, title, avg): one row per item, so titles may repeat."""
    return state.select("item_id", "title", "avg")


def title_merged(state: DataFrame) -> DataFrame:
    """(title, sum_avg): averages of items sharing a title, added."""
    return state.groupBy("title").agg(F.sum("avg").alias("sum_avg"))


def keyword_average(state: DataFrame, keywords: Iterable[str], rated_only: bool = False) -> DataFrame:
    """One row ``keyword_avg``: mean of item averages over items carrying all keywords.

    Unrated items count as 0.0 (``rated_only=False``, the original behaviour) or are
    skipped (``rated_only=True``). No matching item, or no keyword, gives -1.0.
    """
    keywords = list(keywords)
    matched = state.where(has_all_tags("tags", keywords)) if keywords else state.where(F.lit(False))
    if rated_only:
        matched = matched.where(F.col("n") > 0)
    return matched.agg(F.coalesce(F.avg("avg"), F.lit(-1.0)).alias("keyword_avg"),
                       F.count(F.lit(1)).alias("n_items"))


def keyword_averages(state: DataFrame, queries: DataFrame, rated_only: bool = False) -> DataFrame:
    """Many keyword queries in one plan: ``queries(query_id, keywords array<string>)``
    -> (query_id, keyword_avg, n_items).

    Items are first collapsed to their distinct tag sets (sum and count of averages per
    set, with a partial aggregate in every task), so the matching below runs over tag
    sets, not items; a tag set shared by a large share of the items is one row. A query is
    joined to the tag sets of its rarest keyword only, and each such set is then checked for
    all of them. There is no theta or cross join.
    """
    return averages_from_postings(tag_postings(state), queries, rated_only)


def tag_postings(state: DataFrame) -> DataFrame:
    """(tag, tag_set, sum_avg, n_items, n_rated): each distinct tag set under each of its tags, with
    the sum and count over its items. Unrated items have an average of 0."""
    sets = (state.select(F.array_sort(F.array_distinct("tags")).alias("tag_set"), "avg", "n").groupBy("tag_set")
            .agg(F.sum("avg").alias("sum_avg"), F.count(F.lit(1)).alias("n_items"), F.count_if(F.col("n") > 0).alias("n_rated")))
    return sets.select(F.explode("tag_set").alias("tag"), "tag_set", "sum_avg", "n_items", "n_rated")


def averages_from_postings(postings: DataFrame, queries: DataFrame, rated_only: bool = False) -> DataFrame:
    """``keyword_averages`` from the postings of a state."""
    counted = F.col("n_rated") if rated_only else F.col("n_items")
    set_tags = postings.select("tag", "tag_set", "sum_avg", counted.alias("n_items")).where("n_items > 0")
    q = queries.select("query_id", F.array_distinct("keywords").alias("kw"))
    q_sizes = q.select("query_id", F.size("kw").alias("n_kw"))
    in_sets = set_tags.groupBy("tag").agg(F.count(F.lit(1)).alias("n_sets"))
    rarest = (q.select("query_id", "kw", F.explode("kw").alias("tag")).join(in_sets, "tag", "left")
              .groupBy("query_id", "kw").agg(F.min(F.struct(F.coalesce("n_sets", F.lit(0)).alias("n"), "tag")).alias("least"))
              .select("query_id", "kw", F.col("least.tag").alias("tag")))
    per_query = (rarest.join(set_tags, "tag").where(F.size(F.array_except("kw", "tag_set")) == 0)
                 .groupBy("query_id").agg(F.sum("sum_avg").alias("sum_avg"), F.sum("n_items").alias("n_items")))
    return (q_sizes.join(per_query, "query_id", "left")
            .select("query_id",
                    F.when((F.col("n_kw") == 0) | F.col("n_items").isNull(), F.lit(-1.0))
                    .otherwise(F.col("sum_avg") / F.col("n_items")).alias("keyword_avg"),
                    F.coalesce(F.col("n_items"), F.lit(0).cast("bigint")).alias("n_items")))


class KeywordIndex:
    """An inverted index from tags to tag sets with partial sums, kept up to date by the
    differences that updates make.

    Items of the same tags are one entry, so the index is as large as the different tag sets and
    not as the items. An update adds up the differences of the touched items' averages by tag set
    and rewrites the index; the state isn't read again. Register it with
    ``MaintainedAverages.listeners`` to follow a state."""

    def __init__(self, spark: SparkSession, state: DataFrame):
        self._spark, self._path = spark, ""
        self._store(tag_postings(state))

    def _store(self, postings: DataFrame) -> None:
        old, self._path = self._path, scratch_path(self._spark, "keyword-index")
        postings.write.parquet(self._path)
        self.postings = self._spark.read.schema(postings.schema).parquet(self._path)
        if old:
            remove_path(self._spark, old)

    def averages(self, queries: DataFrame, rated_only: bool = False) -> DataFrame:
        return averages_from_postings(self.postings, queries, rated_only)

    def apply(self, changes: DataFrame) -> None:
        """changes: (item_id, tags, old_n, old_avg, n, avg)."""
        rated = (F.col("n") > 0).cast("bigint") - (F.col("old_n") > 0).cast("bigint")
        differences = (changes.groupBy(F.array_sort(F.array_distinct("tags")).alias("tag_set"))
                       .agg(F.sum(F.col("avg") - F.col("old_avg")).alias("d_sum"), F.sum(rated).alias("d_rated")))
        self._store(self.postings.join(differences, "tag_set", "left").select(
            "tag", "tag_set", (F.col("sum_avg") + F.coalesce("d_sum", F.lit(0.0))).alias("sum_avg"), "n_items",
            (F.col("n_rated") + F.coalesce("d_rated", F.lit(0))).alias("n_rated")))

    def remove(self) -> None:
        remove_path(self._spark, self._path)
