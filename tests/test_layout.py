import os

import pytest
from pyspark.sql import functions as F

from rateflow.operators.layout import BucketedRatings, ClusteredRatings

RATINGS = "user_id long, item_id long, rating double, ts long"


@pytest.fixture(scope="module")
def hot(spark):
    """One user holds a third of all ratings; some ratings have no user."""
    rows = [(-1 if i % 3 == 0 else i % 97, i % 41, float(i % 9), i) for i in range(3000)] + [(None, 5, 1.0, 0)] * 2
    return spark.createDataFrame(rows, RATINGS).repartition(4).cache()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_join_equals_the_plain_one(spark, hot):
    stored = BucketedRatings(spark, hot, buckets=8)
    assert sorted(map(repr, stored.rows().collect())) == sorted(map(repr, hot.collect()))
    assert {r.user_id for r in stored.hot.select("user_id").distinct().collect()} == {-1}
    averages = stored.per_key(F.avg("rating").alias("a"), F.count(F.lit(1)).alias("n"))
    plain = hot.groupBy("user_id").agg(F.avg("rating").alias("a"), F.count(F.lit(1)).alias("n"))
    assert sorted(map(repr, averages.collect())) == sorted(map(repr, plain.collect()))
    for how in ("inner", "left"):
        got, expected = stored.join(averages, how), hot.join(plain, "user_id", how)
        assert got.columns == expected.columns and sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))
    with pytest.raises(ValueError, match="unsupported"):
        stored.join(averages, "right")
    tables = [n for n, _ in stored._tables]
    stored.remove()
    assert not any(spark.catalog.tableExists(n) for n in tables)


def test_bucketed_ratings_are_not_shuffled(spark, hot):
    stored = BucketedRatings(spark, hot, buckets=8)
    averages = stored.per_key(F.avg("rating").alias("a"))
    assert "Exchange hashpartitioning" not in _plan(stored.cold.groupBy("user_id").agg(F.avg("rating")))
    plan = _plan(stored.join(averages))
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan and "Bucketed: true" in plan
    # A plain table is shuffled for the same join.
    assert "Exchange hashpartitioning" in _plan(hot.join(averages.hint("merge"), "user_id"))
    # The hot user is not in any bucket, and the largest bucket is near the average.
    sizes = [r["count"] for r in stored.cold.groupBy(F.expr("pmod(hash(user_id), 8)")).count().collect()]
    assert max(sizes) < 2 * sum(sizes) / len(sizes)
    stored.remove()


def test_lookup_reads_few_row_groups(spark):
    n = 200_000
    rows = spark.range(n).select((F.col("id") * 7919 % 20_000).alias("user_id"), F.col("id").alias("item_id"),
                                 (F.col("id") % 10 / 2).alias("rating"), F.hash("id").cast("long").alias("ts"))
    stored = ClusteredRatings(spark, rows, row_group_bytes=1 << 16)
    found = stored.lookup([17, 4711, 4711, 99_999])
    expected = rows.where("user_id in (17, 4711, 99999)")
    assert sorted(found.collect()) == sorted(expected.collect()) and found.count() == 20
    leaf = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    read = leaf.metrics().get("numOutputRows").get().value()
    assert 0 < read < n / 10
    assert "PushedFilters: [In(user_id" in _plan(found)
    some = rows.where("user_id % 50 = 3").select("user_id")
    assert stored.lookup_all(some).count() == some.count() == stored.lookup(r.user_id for r in some.distinct().collect()).count()
    assert stored.lookup([]).collect() == []
    path = stored._path.removeprefix("file:")
    stored.remove()
    assert not os.path.exists(path)


def test_more_keys_than_a_filter_holds(spark, hot, monkeypatch):
    monkeypatch.setattr("rateflow.operators.layout.MOST_KEYS", 3)
    stored = ClusteredRatings(spark, hot)
    keys = [-1, 2, 5, 7, 11]
    assert sorted(stored.lookup(keys).collect()) == sorted(hot.where(F.col("user_id").isin(keys)).collect())


def test_no_ratings(spark, hot):
    stored = BucketedRatings(spark, hot.limit(0), buckets=4)
    assert stored.join(stored.per_key(F.avg("rating").alias("a"))).collect() == []
    assert ClusteredRatings(spark, hot.limit(0)).lookup([1]).collect() == []
