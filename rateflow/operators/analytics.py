"""Per-year and per-tag analytics over ratings and items.

All aggregates are hash aggregates with a map-side partial step, so a year or an item
that holds a large share of the ratings is pre-reduced in every task before the
shuffle; no operator gathers a group's rows in one place.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.functions.tags import has_all_tags, has_any_tag
from rateflow.functions.time import year_of_epoch


def dedup_items(items: DataFrame) -> DataFrame:
    """One row per item id. Duplicates resolve deterministically to the smallest
    ``(title, tags)``."""
    return (items.groupBy("item_id")
            .agg(F.min(F.struct("title", "tags")).alias("m"))
            .select("item_id", "m.title", "m.tags"))


def rating_counts_by_year_item(ratings: DataFrame) -> DataFrame:
    """(year, item_id, n): number of ratings of an item within a year."""
    return (ratings.select(year_of_epoch("ts").alias("year"), "item_id")
            .groupBy("year", "item_id").agg(F.count(F.lit(1)).alias("n")))


def items_rated_per_year(ratings: DataFrame) -> DataFrame:
    """(year, n_items): distinct items rated in each year. Ratings of unknown items
    count too, as nothing is joined."""
    return items_counted_per_year(rating_counts_by_year_item(ratings))


def items_counted_per_year(counts: DataFrame) -> DataFrame:
    """The same from a (year, item_id, n) table."""
    return counts.groupBy("year").agg(F.count(F.lit(1)).alias("n_items"))


def year_winners(counts: DataFrame, items: DataFrame) -> DataFrame:
    """(year, item_id, title, tags, n_ratings): per year the item with most ratings, from a
    (year, item_id, n) table and items with one row per id; ties go to the largest id.
    Ratings of unknown items drop out. Only ids and counts go through the large join; titles
    and tags are joined to the few winners."""
    best = (counts.join(items.select("item_id"), "item_id", "left_semi")
            .groupBy("year").agg(F.max(F.struct("n", "item_id")).alias("w"))
            .select("year", "w.item_id", F.col("w.n").alias("n_ratings")))
    return best.join(items, "item_id").select("year", "item_id", "title", "tags", "n_ratings")


def _year_winners(ratings: DataFrame, items: DataFrame) -> DataFrame:
    return year_winners(rating_counts_by_year_item(ratings), dedup_items(items))


def top_item_per_year(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """(year, item_id, title, n_ratings)."""
    return _year_winners(ratings, items).drop("tags")


def top_tags_per_year(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """(year, item_id, tags, n_ratings): the tag list of each year's most rated item."""
    return _year_winners(ratings, items).drop("title")


def tag_years_won(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """(tag, n_years): in how many years the tag is on the year's most rated item.
    Tags that never win are absent."""
    return years_won_by_tag(_year_winners(ratings, items))


def years_won_by_tag(winners: DataFrame) -> DataFrame:
    """The same from the table of ``year_winners``."""
    return (winners.select("year", F.explode("tags").alias("tag")).distinct()
            .groupBy("tag").agg(F.count(F.lit(1)).alias("n_years")))


def least_most_tag(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """One row: the least winning tag (fewest years, then smallest name) and the most
    winning tag (most years, then largest name)."""
    return least_and_most(tag_years_won(ratings, items))


def least_and_most(won: DataFrame) -> DataFrame:
    """The same from a (tag, n_years) table."""
    return won.agg(F.min(F.struct("n_years", "tag")).alias("lo"),
                   F.max(F.struct("n_years", "tag")).alias("hi")).select(
        F.col("lo.tag").alias("least_tag"), F.col("lo.n_years").alias("least_years"),
        F.col("hi.tag").alias("most_tag"), F.col("hi.n_years").alias("most_years"))


def items_with_all_tags(items: DataFrame, required: Iterable[str]) -> DataFrame:
    """Items carrying every required tag; an empty requirement keeps all items.
    The list is a literal in the predicate, shipped with the plan to every task."""
    return items.where(has_all_tags("tags", required))


def items_with_any_tag(items: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Items carrying at least one of the tags; an empty list keeps none."""
    return items.where(has_any_tag("tags", wanted))
