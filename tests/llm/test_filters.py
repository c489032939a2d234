"""Filters of ids and hashes against plain sets, and what the driver puts into plans for them."""

import pytest
from pyspark.sql import functions as F

from rateflow.llm import common
from rateflow.llm.common import drop_rows, fresh_path, hash_filter, id_filter, row_key
from tests.llm.helpers import documents


def _bitmaps(monkeypatch):
    """Longs in each bitmap that is written from now on."""
    sizes, plain = [], common.written

    def seen(df, name):
        out = plain(df, name)
        if name == "bitmap":
            sizes.append(out.select(F.expr("aggregate(b, 0, (n, x) -> n + size(x))")).first()[0])
        return out

    monkeypatch.setattr(common, "written", seen)
    return sizes


def _bits(ids, share, most):
    bits = common.LEAST_BITS
    while bits < min(ids * share, most):
        bits *= 2
    return bits


@pytest.mark.parametrize("n", [0, 1, 1_024, 1_025, 3_000, 200_000])
def test_every_id_passes_and_few_others(spark, monkeypatch, n):
    sizes = _bitmaps(monkeypatch)
    may_hold = id_filter(spark.range(n).select(F.col("id").alias("k")), "k")
    bits = _bits(n, common.ID_BITS, common.FILTER_BITS)
    assert sizes == [bits // 64]
    assert spark.range(n).where(may_hold(F.col("id"))).count() == n
    others = spark.range(n, n + 20_000).where(may_hold(F.col("id"))).count()
    assert others <= 20_000 * (2 * n / bits) + 5


def test_hashes_with_all_bits_and_signs(spark, monkeypatch):
    hashes = [-(1 << 63), (1 << 63) - 1, -1, 0, 1, 63, 64, -64, 1 << 24, 12345678901]
    rows = spark.createDataFrame([(h,) for h in hashes * 2], "h long")
    for share in (common.HASH_BITS, 1 << 30):
        monkeypatch.setattr(common, "HASH_BITS", share)
        may_hold = hash_filter(rows, "h")
        assert rows.where(may_hold(F.col("h"))).count() == len(hashes) * 2
        assert spark.createDataFrame([(2,), (-2,), (99,)], "h long").where(may_hold(F.col("h"))).count() == 0


def test_few_rows_to_drop_need_a_small_bitmap(spark, monkeypatch):
    sizes = _bitmaps(monkeypatch)
    docs = documents(spark, [(i, f"text {i}") for i in range(300)] + [(7, "text 7")])
    gone = docs.where("doc_id % 3 = 1").select(row_key().alias("row_key"))
    kept = drop_rows(docs, gone)
    kept.write.parquet(path := fresh_path(spark, "kept"))
    assert sorted(r.doc_id for r in spark.read.parquet(path).collect()) == [i for i in range(300) if i % 3 != 1]
    assert len(sizes) == 1 and sizes[0] <= common.LEAST_BITS // 64
