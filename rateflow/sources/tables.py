"""Bindings of the driver's parquet tables to the engine's items / ratings / deltas.

  items    part:              item_id = p_partkey, title = p_name,
                              tags = [p_type] ++ split(p_name, ' ')
  ratings  lineitem x orders: user_id = o_custkey, item_id = l_partkey,
                              rating = ceil(l_quantity / 5) / 2  (0.5 .. 5.0 in half steps),
                              ts = epoch seconds of l_shipdate, old_rating = NULL
  base     ratings shipped before 2001-06-01
  deltas   all other ratings; rows with l_returnflag = 'R' are corrections whose old
           rating is 0.5 * ((l_linenumber % 9) + 1)

The split is for the incremental queries alone, and base and deltas together are all
ratings. Every other query reads all ratings.

Filters are applied to the lineitem scan before the join so they reach Parquet as
pushed filters; only the needed columns are read. Keys stay ``bigint`` so equality
predicates on them can be pushed down too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed cut date of the base / delta split.
DELTA_FROM = "2001-06-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def items_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.concat(F.array(F.col("p_type")), F.split(F.col("p_name"), " ")).alias("tags"),
    )


def _epoch_seconds(c: Column) -> Column:
    return F.unix_timestamp(c).cast("bigint")


def _ratings(spark: SparkSession, sf_dir: str, shipdate_filter: Column | None,
             with_old: bool) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    if shipdate_filter is not None:
        li = li.where(shipdate_filter)
    cols = ["l_orderkey", "l_partkey", "l_quantity", "l_shipdate"]
    if with_old:
        cols += ["l_returnflag", "l_linenumber"]
    li = li.select(*cols)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
    old = (F.when(F.col("l_returnflag") == "R",
                  F.lit(0.5) * (F.pmod(F.col("l_linenumber"), F.lit(9)) + 1))
           if with_old else F.lit(None)).cast("double")
    return joined.select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        old.alias("old_rating"),
        (F.ceil(F.col("l_quantity") / 5) / 2).cast("double").alias("rating"),
        _epoch_seconds(F.col("l_shipdate")).alias("ts"),
    )


def ratings_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ratings(spark, sf_dir, None, with_old=False)


def base_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ratings(spark, sf_dir, F.col("l_shipdate") < F.lit(DELTA_FROM).cast("timestamp_ntz"),
                    with_old=False)


def delta_ratings(spark: SparkSession, sf_dir: str, until: str | None = None,
                  since: str | None = None) -> DataFrame:
    """Deltas, optionally restricted to ``[since, until)`` on the ship date."""
    cond = F.col("l_shipdate") >= F.lit(since or DELTA_FROM).cast("timestamp_ntz")
    if until is not None:
        cond = cond & (F.col("l_shipdate") < F.lit(until).cast("timestamp_ntz"))
    return _ratings(spark, sf_dir, cond, with_old=True)
