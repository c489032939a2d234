from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rateflow.functions.hashing import minhash_seed
from rateflow.operators import lsh as L

BUCKETS = {
    (30680, 44455): [1, 2116, 3114, 78499],
    (59702, 13197): [260, 1196, 1210, 2628, 5378, 33493, 72998, 122886, 166528, 179819],
    (59702, 44455): [4993, 5952, 7153],
}


def java_hash(s: str) -> int:
    """Brute-force Java String.hashCode over UTF-16 code units (test oracle)."""
    h = 0
    data = s.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (31 * h + int.from_bytes(data[i:i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h


def i32(x):
    x &= 0xFFFFFFFF
    return x - (1 << 32) if x >= (1 << 31) else x


def brute_minhash(tag: str, seed: int) -> int:
    k = java_hash(tag + str(seed))
    k = i32(k * 0xCC9E2D51)
    k >>= 15
    k = i32(k * 0x1B873593)
    k >>= 13
    return abs(k)


def test_golden_buckets(items):
    idx = L.lsh_index(items)
    got = {}
    for r in idx.collect():
        got.setdefault((r.sig_0, r.sig_1), []).append(r.item_id)
    assert {k: sorted(v) for k, v in got.items()} == BUCKETS
    sizes = {(r.sig_0, r.sig_1): r.n_items for r in L.bucket_sizes(idx).collect()}
    assert sizes == {k: len(v) for k, v in BUCKETS.items()}


def test_every_item_finds_itself(items):
    idx = L.lsh_index(items)
    q = items.select(F.col("item_id").alias("qid"), "tags")
    hits = L.lsh_lookup(idx, q).where(F.col("qid") == F.col("item_id"))
    assert hits.count() == 17


def test_self_join_bucket_lists(items):
    idx = L.lsh_index(items)
    q = items.select(F.col("item_id").alias("qid"), "tags")
    res = L.lsh_lookup(idx, q).groupBy("qid").agg(F.sort_array(F.collect_list("item_id")).alias("ids"))
    bucket_of = {i: sorted(v) for v in BUCKETS.values() for i in v}
    for r in res.collect():
        assert r.ids == bucket_of[r.qid]


def test_unmatched_queries(spark, items):
    idx = L.lsh_index(items)
    q = spark.createDataFrame([(["space"],), (["cowboy"],), ([],)], "tags array<string>")
    kept = L.lsh_lookup(idx, q).collect()
    assert len(kept) == 3 and all(r.item_id is None for r in kept)
    assert L.lsh_lookup(idx, q, keep_unmatched=False).count() == 0


def test_payload_and_duplicates_are_carried(spark, items):
    idx = L.lsh_index(items)
    q = spark.createDataFrame([(1, ["Adventure", "Fantasy"]), (2, ["Adventure", "Fantasy"])],
                              "payload int, tags array<string>")
    out = L.lsh_lookup(idx, q)
    assert sorted({r.payload for r in out.collect()}) == [1, 2]
    assert out.count() == 6


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(min_size=0, max_size=12), min_size=1, max_size=6), st.integers(-50, 50))
def test_hash_matches_brute_force(spark, tags, seed):
    df = spark.createDataFrame([(t,) for t in tags], "t string")
    got = [r.h for r in df.select(minhash_seed("t", seed).alias("h")).collect()]
    assert got == [brute_minhash(t, seed) for t in tags]


def test_hash_non_bmp(spark):
    tags = ["😀x", "é", "日本", "a\U0001F600b"]
    df = spark.createDataFrame([(t,) for t in tags], "t string")
    got = [r.h for r in df.select(minhash_seed("t", 5).alias("h")).collect()]
    assert got == [brute_minhash(t, 5) for t in tags]


def test_tag_hashes_table(items):
    th = L.tag_hashes(items).collect()
    n_tags = items.select(F.explode("tags")).distinct().count()
    assert len(th) == 2 * n_tags
    for r in th:
        assert r.hash == brute_minhash(r.tag, r.seed)
