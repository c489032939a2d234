"""Stored layouts of the ratings for work that comes back to them again and again.

``BucketedRatings`` stores them by a key (user or item) in buckets, so that per-key aggregates and
joins with per-key tables read them without a shuffle. A bucket can't be split when it is
joined, so keys that hold more than HOT_SHARE of a bucket's fair share are kept apart in a
plain table, and join the few per-key rows of such keys by broadcast: there are fewer of
them than buckets / HOT_SHARE, whatever the size of the ratings.

``ClusteredRatings`` stores them sorted by a key in small row groups with bloom filters, so that a
lookup of some keys reads the row groups that hold them and not the table.

Both write under the session's shared folder; ``remove`` deletes what they stored. Ratings
without the key (null) are kept: they are in no bucketed join and no lookup, as in plain joins.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.session import materialize, remove_path, scratch_path

BUCKETS = 64
# A key is hot above this multiple of the rows that a bucket holds on average.
HOT_SHARE = 0.5
ROW_GROUP_BYTES = 1 << 20
# Keys of a lookup that go into the scan's filter; more are joined.
MOST_KEYS = 1000


class BucketedRatings:
    def __init__(self, spark: SparkSession, ratings: DataFrame, key: str = "user_id", buckets: int = BUCKETS):
        self._spark, self.key, self.buckets = spark, key, buckets
        self._tables: list[tuple[str, str]] = []
        counts = materialize(ratings.groupBy(key).agg(F.count(F.lit(1)).alias("n")), "key-counts")
        total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
        # Fewer than buckets / HOT_SHARE keys.
        hot = materialize(counts.where(F.col("n") > max(1, HOT_SHARE * total / buckets)).select(key), "hot-keys")
        few = F.broadcast(hot)
        self.cold = self._bucketed(ratings.join(few, key, "left_anti"))
        self._hot_path = scratch_path(spark, "hot-ratings")
        ratings.join(few, key, "left_semi").select(*ratings.columns).write.parquet(self._hot_path)
        self.hot = spark.read.schema(ratings.schema).parquet(self._hot_path)
        self._hot_keys = hot

    def _bucketed(self, df: DataFrame) -> DataFrame:
        name, path = f"rateflow_{self.key}_{uuid.uuid4().hex[:12]}", scratch_path(self._spark, f"by-{self.key}")
        (df.repartition(self.buckets, self.key).write.bucketBy(self.buckets, self.key).sortBy(self.key)
         .option("path", path).saveAsTable(name))
        self._tables.append((name, path))
        return self._spark.table(name)

    def rows(self) -> DataFrame:
        return self.cold.unionByName(self.hot)

    def per_key(self, *aggregates) -> DataFrame:
        """A table of aggregates by key, stored in the same buckets. Ratings of cold keys aren't
        shuffled; those of hot ones are aggregated in every task first."""
        both = self.cold.groupBy(self.key).agg(*aggregates).unionByName(self.hot.groupBy(self.key).agg(*aggregates))
        return self._bucketed(both)

    def join(self, per_key: DataFrame, how: str = "inner") -> DataFrame:
        """The ratings with a table made by ``per_key``; neither side of the cold keys is shuffled."""
        if how not in ("inner", "left"):
            raise ValueError(f"unsupported join type: {how}")
        columns = [*self.cold.columns, *(c for c in per_key.columns if c != self.key)]
        few = per_key.join(F.broadcast(self._hot_keys), self.key, "left_semi")
        cold = self.cold.join(per_key.hint("merge"), self.key, how)
        hot = self.hot.join(F.broadcast(few), self.key, how)
        return cold.select(*columns).unionByName(hot.select(*columns))

    def remove(self) -> None:
        for name, path in self._tables:
            self._spark.sql(f"DROP TABLE IF EXISTS {name}")
            remove_path(self._spark, path)
        remove_path(self._spark, self._hot_path)


class ClusteredRatings:
    def __init__(self, spark: SparkSession, ratings: DataFrame, key: str = "user_id", row_group_bytes: int = ROW_GROUP_BYTES):
        self._spark, self.key, self._path = spark, key, scratch_path(spark, f"clustered-by-{key}")
        # Rows of a hot key are spread over several ranges by the other columns.
        order = [key, *(c for c in ("item_id", "user_id", "ts") if c in ratings.columns and c != key)]
        (ratings.repartitionByRange(*order).sortWithinPartitions(*order).write
         .option("parquet.block.size", str(row_group_bytes))
         .option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(self._path))
        self.rows = spark.read.schema(ratings.schema).parquet(self._path)

    def lookup(self, keys: Iterable[int]) -> DataFrame:
        """All rows of some keys, given on the driver."""
        keys = sorted({int(k) for k in keys})
        if len(keys) > MOST_KEYS:
            return self.lookup_all(self._spark.createDataFrame([(k,) for k in keys], f"{self.key} bigint"))
        return self.rows.where(F.col(self.key).isin(keys)) if keys else self.rows.limit(0)

    def lookup_all(self, keys: DataFrame) -> DataFrame:
        """All rows of the keys of a table."""
        return self.rows.join(keys.select(self.key).distinct(), self.key, "left_semi").select(*self.rows.columns)

    def remove(self) -> None:
        remove_path(self._spark, self._path)
