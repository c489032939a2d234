"""Helpers shared by the operators: tables written to the shared folder, id filters.

A table that several later steps read is written as Parquet under the session's shared
checkpoint folder and read back (``written``). That cuts the lineage, survives lost
executors and gives later joins two plain shuffles, which AQE can split when a key is hot.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.session import scratch_path

# Paths written for each Spark application and scope, for release_scratch().
_WRITTEN: dict[tuple[str, str], list[str]] = {}
_SCOPE = [""]

# Bits of an id filter: 1 MiB at most, whatever the number of ids; of a filter of passages'
# hashes in the JVM, 2 MiB at most; and of one that tasks hold in Python, 8 MiB.
FILTER_BITS = 1 << 23
HASH_FILTER_BITS = 1 << 24
WIDE_FILTER_BITS = 1 << 26
# Bits for each id while a filter in the JVM has fewer; for each hash; and the fewest of a filter.
ID_BITS = 64
HASH_BITS = 32
LEAST_BITS = 1 << 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    path = scratch_path(spark, name)
    _WRITTEN.setdefault((spark.sparkContext.applicationId, _SCOPE[-1]), []).append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back from there."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_scope(name: str) -> Iterator[None]:
    """Tables written inside belong to this scope."""
    _SCOPE.append(name)
    try:
        yield
    finally:
        _SCOPE.pop()


def release_scratch(spark: SparkSession, scope: str) -> None:
    """Delete the tables that were written in a scope. Only for callers that have stored what
    they made from them, such as a pipeline between two stages."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in _WRITTEN.pop((spark.sparkContext.applicationId, scope), []):
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def bitmap(slots: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """The distinct values of the column ``slot`` (0 to bits - 1) as a bitmap. bits / 64 rows
    at most come to the driver."""
    words = (slots.groupBy((F.col("slot") / 64).cast("int").alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits"))
             .toArrow())
    out = np.zeros(bits // 64, np.uint64)
    out[words.column("w").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def in_bitmap(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return ((bits[slots >> 6] >> (slots & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


def _bit_test(hashes: DataFrame, share: int, most: int):
    """A test of hashes against the column ``hash``, in the JVM.

    The bitmap is one row with an array of arrays of 1024 longs, read as a scalar subquery. The
    driver puts it into every stage that tests, several times, so that few ids get few bits: a
    power of two, at least ``share`` for each until that is ``most``."""
    spark = hashes.sparkSession
    ids = hashes.agg(F.count(F.lit(1))).scalar()
    wanted = F.least(F.greatest(ids * share, F.lit(LEAST_BITS)), F.lit(most))
    bits = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.length(F.bin(wanted - 1)))
    every = spark.range(most // 64).where(F.col("id") * 64 < bits).select(F.col("id").alias("w"), F.lit(0).cast("bigint").alias("b"))
    words = (hashes.select((F.pmod("hash", bits) / 64).cast("bigint").alias("w"), F.expr("shiftleft(1L, cast(pmod(hash, 64L) as int))").alias("b"))
             .unionByName(every).groupBy("w").agg(F.bit_or("b").alias("b")))

    def in_order(key: str, value: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.struct(key, value))), lambda x: x[value]).alias(value)

    blocks = words.withColumn("block", F.shiftright("w", 10)).groupBy("block").agg(in_order("w", "b"))
    bitmap_ = written(blocks.agg(in_order("block", "b")), "bitmap")
    held = bitmap_.select(F.size("b")).first()[0] << 16
    packed = bitmap_.scalar()

    def test(hash_: Column) -> Column:
        slot = F.pmod(hash_, F.lit(held))
        word = F.get(F.get(packed, F.shiftright(slot, 16).cast("int")), F.shiftright(slot, 6).bitwiseAND(F.lit(1023)).cast("int"))
        return F.getbit(word, F.pmod(slot, F.lit(64)).cast("int")) == 1

    return test


def hash_filter(hashes: DataFrame, column: str):
    """Like id_filter, for a column of 64-bit hashes, with HASH_BITS bits for each until that is
    HASH_FILTER_BITS."""
    return _bit_test(hashes.select(F.col(column).alias("hash")), HASH_BITS, HASH_FILTER_BITS)


def id_filter(ids: DataFrame, *columns: str):
    """A bitmap of hashed ids and the test for it.

    Returns ``may_hold(*cols) -> Column``: true for every id of ``ids``, and for some
    others. The bitmap has ID_BITS bits for each id and at most FILTER_BITS; with very many ids
    it lets everything through, so callers always follow it with an exact join.
    """
    test = _bit_test(ids.select(F.xxhash64(*(F.col(c) for c in columns)).alias("hash")), ID_BITS, FILTER_BITS)
    return lambda *cols: test(F.xxhash64(*cols))


def row_key() -> Column:
    """Tells document rows apart by id and text; equal rows have equal keys."""
    return F.xxhash64("doc_id", "text")


def fresh_name(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name = f"_{name}"
    return name


def drop_rows(docs: DataFrame, gone: DataFrame, by: Column | None = None) -> DataFrame:
    """docs without the rows whose key (row_key(), or ``by``) is in gone's column ``row_key``.

    Rows that the id filter clears are read and passed on; only the others are joined, so
    the texts that stay aren't shuffled unless very many rows go."""
    key = fresh_name(docs, "row_key")
    keys = gone.select(F.col("row_key").alias(key)).distinct()
    may_hold = id_filter(gone, "row_key")
    keyed = docs.withColumn(key, row_key() if by is None else by)
    doubt = keyed.where(may_hold(F.col(key))).join(keys, key, "left_anti")
    return keyed.where(~may_hold(F.col(key))).unionByName(doubt).select(*docs.columns)


def with_texts(docs: DataFrame, per_row: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of per_row (one for each ``row_key``) with these columns of the document rows
    of that key. Only texts that an id filter lets through are shuffled."""
    may_hold = id_filter(per_row, "row_key")
    return (docs.select(row_key().alias("row_key"), *columns).where(may_hold(F.col("row_key")))
            .join(per_row, "row_key"))


def document_order() -> Column:
    """doc_id as a number to order documents by; rows without one come last."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1))
