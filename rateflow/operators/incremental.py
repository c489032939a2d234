"""Incremental maintenance of per-item averages from rating deltas.

A delta row is a new rating (``old_rating`` NULL) or a correction of an earlier one
(``old_rating`` set). Per item the deltas fold to ``ds = sum(rating - coalesce(old, 0))``
and ``dn = number of new ratings``; both are sums, so the fold is order independent and
pre-aggregates in every task before the shuffle. Applying a fold is a key join of two
one-row-per-item tables: ``s += ds``, ``n += dn``, ``avg = s / n`` for touched items,
untouched items keep their row as is. Deltas for unknown items are dropped.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rateflow.session import ScratchScope, list_names, materialize, read_text, remove_path, scratch_path, write_text

# Parts of a stored state; one of them is the least that an update rewrites.
PARTS = 64


def delta_fold(deltas: DataFrame) -> DataFrame:
    """(item_id, ds, dn, n_rows)."""
    return deltas.groupBy("item_id").agg(
        F.sum(F.col("rating") - F.coalesce(F.col("old_rating"), F.lit(0.0))).alias("ds"),
        F.count_if(F.col("old_rating").isNull()).alias("dn"),
        F.count(F.lit(1)).alias("n_rows"))


def apply_fold(state: DataFrame, fold: DataFrame) -> DataFrame:
    """Merge a delta fold (item_id, ds, dn) into the state (item_id, title, tags, n, s, avg)."""
    f = fold.select("item_id", "ds", "dn", F.lit(True).alias("_touched"))
    j = state.join(f, "item_id", "left")
    touched = F.col("_touched").isNotNull()
    s = F.when(touched, F.col("s") + F.col("ds")).otherwise(F.col("s"))
    n = F.when(touched, F.col("n") + F.col("dn")).otherwise(F.col("n"))
    # n == 0 after a correction on an unrated item: the average is defined as 0.0.
    avg = F.when(touched, F.coalesce(F.try_divide(s, n), F.lit(0.0))).otherwise(F.col("avg"))
    return j.select("item_id", "title", "tags", n.alias("n"), s.alias("s"), avg.alias("avg"))


def apply_delta(state: DataFrame, deltas: DataFrame) -> DataFrame:
    """New state after a batch of deltas."""
    return apply_fold(state, delta_fold(deltas))


def unmatched_deltas(state: DataFrame, deltas: DataFrame) -> DataFrame:
    """Deltas whose item is not in the state (they are ignored by ``apply_delta``)."""
    return deltas.join(state.select("item_id"), "item_id", "left_anti")


def changed_items(state: DataFrame, fold: DataFrame) -> DataFrame:
    """(item_id, tags, old_n, old_avg, n, avg) of the items that a fold touches."""
    touched = state.join(fold.select("item_id"), "item_id", "left_semi")
    old = touched.select("item_id", F.col("n").alias("old_n"), F.col("avg").alias("old_avg"))
    return apply_fold(touched, fold).select("item_id", "tags", "n", "avg").join(old, "item_id")


class MaintainedAverages:
    """Holds the current state and applies deltas to it.

    The state is stored in ``parts`` parts by a hash of item_id under a folder of its own. An
    update reads and rewrites only the parts with touched items, as a new version of them, and
    then publishes a manifest that names the version of every part. Readers go by the manifest,
    so an update that fails leaves the version before it readable, and the folder can be opened
    again later (``MaintainedAverages.open``). What a manifest no longer names is removed after
    the next one is published; a table read before an update must not be used after it.

    ``listeners`` are given the changed items of each update (see ``KeywordIndex``).
    """

    def __init__(self, spark: SparkSession, state: DataFrame, parts: int = PARTS, path: str | None = None):
        self._spark, self._parts = spark, parts
        self._path = path or scratch_path(spark, "averages")
        self._schema = state.schema
        self._version, self._of_part = 0, {}
        self.listeners: list = []
        self._publish(state, range(parts))

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> MaintainedAverages:
        """The state that was last published in a folder."""
        last = [n for n in list_names(spark, path) if n.startswith("manifest-")][-1]
        held = json.loads(read_text(spark, f"{path}/{last}"))
        self = cls.__new__(cls)
        self._spark, self._path, self._parts, self._version = spark, path, held["parts"], held["version"]
        self._schema = StructType.fromJson(held["schema"])
        self._of_part = {int(p): v for p, v in held["of_part"].items()}
        self.listeners = []
        return self

    def _folder(self, part: int, version: int) -> str:
        return f"{self._path}/version={version}/part={part}"

    def _read(self, parts) -> DataFrame:
        paths = [self._folder(p, self._of_part[p]) for p in parts if p in self._of_part]
        if not paths:
            return self._spark.createDataFrame([], self._schema)
        return self._spark.read.schema(self._schema).parquet(*paths)

    @property
    def state(self) -> DataFrame:
        return self._read(range(self._parts))

    @property
    def path(self) -> str:
        return self._path

    def _part(self) -> Column:
        return F.pmod(F.xxhash64("item_id"), F.lit(self._parts)).cast("int")

    def _publish(self, rows: DataFrame, parts) -> None:
        """Store these rows, the whole of these parts, as the next version."""
        version = self._version + 1
        out = f"{self._path}/version={version}"
        remove_path(self._spark, out)  # of an update that failed before
        rows.withColumn("part", self._part()).hint("rebalance", "part").write.partitionBy("part").parquet(out)
        held = {int(n.split("=")[1]) for n in list_names(self._spark, out) if n.startswith("part=")}
        of_part = {p: v for p, v in self._of_part.items() if p not in parts} | {p: version for p in held}
        write_text(self._spark, f"{self._path}/manifest-{version:012d}", json.dumps(
            {"version": version, "parts": self._parts, "of_part": of_part, "schema": self._schema.jsonValue()}))
        old, self._of_part, self._version = self._of_part, of_part, version
        for name in list_names(self._spark, self._path):
            if name.startswith("manifest-") and int(name.split("-")[1]) < version:
                remove_path(self._spark, f"{self._path}/{name}")
        for p, v in old.items():
            if of_part.get(p) != v:
                remove_path(self._spark, self._folder(p, v))
        for v in set(old.values()) - set(of_part.values()):
            remove_path(self._spark, f"{self._path}/version={v}")

    def update(self, deltas: DataFrame) -> DataFrame:
        scope = ScratchScope(self._spark)
        try:
            with scope:
                fold = materialize(delta_fold(deltas), "fold")
                # At most ``parts`` numbers.
                parts = sorted(r[0] for r in fold.select(self._part().alias("part")).distinct().collect())
                before = self._read(parts)
                changes = materialize(changed_items(before, fold), "changes") if self.listeners else None
            if parts:
                self._publish(apply_fold(before, fold), parts)
                for listener in self.listeners:
                    listener.apply(changes)
        finally:
            scope.release()
        return self.state

    def remove(self) -> None:
        """Delete the stored state."""
        remove_path(self._spark, self._path)
