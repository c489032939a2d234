"""MinHash LSH index over item tag lists.

The index is kept in long form: one row per item with its signature as flat int
columns ``sig_0 .. sig_{m-1}`` (one per seed). A bucket is the set of rows sharing a
signature; it is never collected into one row, so a bucket that holds a large share
of the items costs nothing special to build. Lookups are equi-joins on the signature
columns: all seeds must match (no banding), candidates are the whole bucket. There are few
different signatures, so a bucket may be far larger than a task should read: large buckets
are joined in parts (``signature_join``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.functions.hashing import DEFAULT_SEEDS, minhash_seed, signature_columns, signature_names, tag_hash_array


# Items of one part of a bucket, and a bound on the number of buckets that have parts.
PART_ITEMS = 100_000
MAX_SPLIT_BUCKETS = 100_000


def signature_join(queries: DataFrame, index: DataFrame, seeds: Sequence[int] = DEFAULT_SEEDS,
                   part_items: int = PART_ITEMS) -> DataFrame:
    """Inner join on the signature. The items of a bucket of more than ``part_items`` are
    dealt by id to as many parts as its size asks, and a query row goes to each part. Fewer
    than MAX_SPLIT_BUCKETS buckets can hold more than 1 / MAX_SPLIT_BUCKETS of the items; only
    those have parts, so the table that says how many is broadcast."""
    sig = signature_names(seeds)
    sizes = index.groupBy(*sig).agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    parts = F.broadcast(sizes.where((F.col("n") > part_items) & (F.col("n") * MAX_SPLIT_BUCKETS > total))
                        .select(*sig, F.ceil(F.col("n") / part_items).cast("int").alias("_parts")))
    count = F.coalesce("_parts", F.lit(1))
    q = (queries.join(parts, sig, "left")
         .withColumn("_part", F.explode(F.sequence(F.lit(0), count - 1))).drop("_parts"))
    i = (index.join(parts, sig, "left")
         .withColumn("_part", F.pmod(F.xxhash64("item_id"), count).cast("int")).drop("_parts"))
    return q.join(i, [*sig, "_part"]).drop("_part")


def tag_hashes(items: DataFrame, seeds: Sequence[int] = DEFAULT_SEEDS) -> DataFrame:
    """(tag, seed, hash) for every distinct tag of the items."""
    tags = items.select(F.explode("tags").alias("tag")).distinct()
    return tags.select("tag", F.explode(F.array(*[
        F.struct(F.lit(s).alias("seed"), minhash_seed("tag", s).alias("hash")) for s in seeds
    ])).alias("h")).select("tag", "h.seed", "h.hash")


def with_signature(df: DataFrame, tags_col: str = "tags",
                   seeds: Sequence[int] = DEFAULT_SEEDS) -> DataFrame:
    """Adds the signature columns. An empty or NULL tag list gets NULLs, which match
    nothing."""
    # Each tag is hashed once; every seed's value follows from that hash.
    return (df.withColumn("_tag_hashes", tag_hash_array(tags_col))
            .select("*", *signature_columns("_tag_hashes", seeds)).drop("_tag_hashes"))


def lsh_index(items: DataFrame, seeds: Sequence[int] = DEFAULT_SEEDS) -> DataFrame:
    """Long-form buckets: (sig_0.., item_id, title, tags).

    Hashing a tag list costs far more than reading it, so items are spread over tasks first: a
    stored item table of a few MB is one scan task."""
    spread = items.select("item_id", "title", "tags").repartition("item_id")
    return with_signature(spread, "tags", seeds).select(
        *signature_names(seeds), "item_id", "title", "tags")


def bucket_sizes(index: DataFrame, seeds: Sequence[int] = DEFAULT_SEEDS) -> DataFrame:
    """(sig_0.., n_items) per bucket; partial aggregation per task."""
    return index.groupBy(*signature_names(seeds)).agg(F.count(F.lit(1)).alias("n_items"))


def lsh_lookup(index: DataFrame, queries: DataFrame, tags_col: str = "tags",
               seeds: Sequence[int] = DEFAULT_SEEDS, keep_unmatched: bool = True) -> DataFrame:
    """Candidates for each query row: the query columns plus ``item_id, item_title,
    item_tags`` of every item in the query's bucket.

    ``keep_unmatched=True`` keeps a query whose bucket does not exist with NULL item
    columns (the documented empty result); ``False`` drops it like an inner join.
    Query rows are carried through whole, so any payload columns survive.
    """
    sig = signature_names(seeds)
    q = with_signature(queries, tags_col, seeds)
    idx = index.select(*sig, F.col("item_id"), F.col("title").alias("item_title"),
                       F.col("tags").alias("item_tags"))
    # Unmatched queries are added back by an anti-join against the distinct bucket keys
    # (one row per bucket), which gives exactly the left-join result.
    hits = signature_join(q, idx, seeds)
    if not keep_unmatched:
        return hits
    misses = q.join(index.select(*sig).distinct(), sig, "left_anti").select(
        "*", F.lit(None).cast("bigint").alias("item_id"), F.lit(None).cast("string").alias("item_title"),
        F.lit(None).cast("array<string>").alias("item_tags"))
    return hits.unionByName(misses)
