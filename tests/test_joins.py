import pytest
from pyspark.sql import functions as F

from rateflow.operators import baseline as B
from rateflow.operators import lsh as L
from rateflow.operators.joins import per_key_join
from rateflow.session import materialize

SKEW = {  # thresholds of a few kB, so that a small hot key counts as skewed
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture()
def small_thresholds(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def skewed(spark):
    """One user holds a third of all rows, all of them identical copies."""
    n = 30000
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("user_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 200).alias("item_id"),
        F.lit(None).cast("double").alias("old_rating"),
        F.when(F.col("id") % 3 == 0, F.lit(4.0)).otherwise((F.col("id") % 10 + 1) / 2.0).alias("rating"),
        F.lit(0).cast("bigint").alias("ts")).repartition(4)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_per_key_join_equals_plain_join(spark, skewed, how):
    ua = B.user_averages(skewed).where("user_id <> 3")   # an unmatched key for the left join
    plain = skewed.join(ua, "user_id", how)
    joined = per_key_join(skewed, materialize(ua, "averages"), "user_id", how)
    cols = sorted(plain.columns)
    assert sorted(map(tuple, plain.select(cols).collect()), key=repr) == \
        sorted(map(tuple, joined.select(cols).collect()), key=repr)


def test_per_key_join_rejects_joins_that_cannot_be_split(skewed):
    with pytest.raises(ValueError, match="unsupported join type"):
        per_key_join(skewed, skewed, "user_id", "outer")


def test_hot_key_is_split_by_size(spark, skewed, small_thresholds):
    different = skewed.repartition(16).withColumn("ts", F.xxhash64(F.monotonically_increasing_id()))
    joined = B.ratings_with_user_avg(different).withColumn("p", F.spark_partition_id())
    rows = joined.collect()
    tasks = {r.p for r in rows if r.user_id == 7}
    assert len(tasks) >= 3 and sum(r.user_id == 7 for r in rows) == 10000 + 20000 // 500
    executed = joined._jdf.queryExecution().executedPlan()
    executed.execute().count()
    assert "skew=true" in executed.toString()


def test_baseline_on_skewed_data_matches_plain(spark, skewed):
    m = B.fit_baseline(skewed)
    nd = {(r.user_id, r.item_id, r.rating): r.ndev for r in B.normalized_deviations(skewed).distinct().collect()}
    ua = {r.user_id: r.user_avg for r in m.user_avg.collect()}
    for r in skewed.where("user_id in (7, 11)").distinct().collect():
        a = ua[r.user_id]
        sc = 5 - a if r.rating > a else (a - 1 if r.rating < a else 1.0)
        assert nd[(r.user_id, r.item_id, r.rating)] == pytest.approx((r.rating - a) / sc)


def test_large_bucket_is_joined_in_parts(spark, small_thresholds):
    """One bucket holds half of all items: more tasks join it than there are buckets."""
    items = spark.range(4000).select(F.col("id").alias("item_id"), F.lit("t").alias("title"),
                                     F.array(F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(
                                         F.concat(F.lit("cold"), F.col("id") % 5))).alias("tags"))
    index = L.lsh_index(items)
    queries = L.with_signature(spark.createDataFrame([(1, ["hot"]), (2, ["cold1"])], "query_id long, tags array<string>"))
    sig = L.signature_names(L.DEFAULT_SEEDS)
    got = L.signature_join(queries, index.select(*sig, "item_id"), part_items=100)
    plain = queries.join(index.select(*sig, "item_id"), sig)
    assert sorted(map(tuple, got.select("query_id", "item_id").collect())) == \
        sorted(map(tuple, plain.select("query_id", "item_id").collect()))
    parts = [r.p for r in got.select(F.spark_partition_id().alias("p"), "query_id").collect() if r.query_id == 1]
    assert len(set(parts)) > 3 and max(parts.count(p) for p in set(parts)) < 1500


def test_split_buckets_keep_rare_ones_whole(spark):
    index = L.lsh_index(spark.createDataFrame([(1, "a", ["x"]), (2, "b", ["y"])], "item_id long, title string, tags array<string>"))
    queries = L.with_signature(spark.createDataFrame([(1, ["x"]), (2, None)], "query_id long, tags array<string>"))
    got = L.signature_join(queries, index.select(*L.signature_names(), "item_id"))
    assert [(r.query_id, r.item_id) for r in got.collect()] == [(1, 1)]
