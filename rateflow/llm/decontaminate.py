"""Benchmark decontamination by winnowing.

A document word is hit when it lies in an occurrence of a benchmark window: ``window``
consecutive words of an item, or a whole item that has fewer words. Both sides keep only
the minimum k-gram hash of every ``window - k + 1`` consecutive k-grams, so two texts that
share ``window`` words always keep the same k-gram of them (the winnowing guarantee).
Kept document k-grams that pass a bitmap of the benchmark's (a fixed size) are joined with
the benchmark's on the hash, and each joined pair is extended to the left and right on
the words themselves, so a hash collision never makes a hit. Items shorter than the
window are fingerprinted whole, and documents are probed at every position for each of
their lengths (fewer than ``window`` different ones).

Defined cases: null and wordless texts have no words; a wordless item has no windows;
equal items are all named; repeated rows each get their own, equal result; rows with a
null doc_id are processed like others; items with a null id make hits but are not named.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateflow.llm import text as T
from rateflow.llm.common import FILTER_BITS, bitmap, in_bitmap, written

WINDOW = 10
K = 5

def _grams(w: T.Words, window: int, k: int, short: list[int], whole: bool, passes) -> list[tuple]:
    """(text, fp, pos, kind, words before, words after) of the kept k-grams. The kind is
    ``window``, or the length of the short item that the words may be. ``whole``: for the
    lengths in ``short`` take texts of just that length only."""
    h = w.hashes()
    out = []
    counts = w.counts()
    for n in [window, *short]:
        size = k if n == window else n
        g = T.gram_hashes(h, size)
        fp = T.mix(g ^ np.uint64(n))
        if n == window:
            at = T.winnow(g, w.first, k, window - k + 1)
        elif whole:
            at = w.first[:-1][counts == n]
        else:
            at = T.gram_positions(w.first, n)
        if passes is not None and len(at):
            at = at[passes(fp[at])]
        side = window - k if n == window else 0
        for p, f in zip(at.tolist(), fp[at].view(np.int64)):
            d = int(w.text[p])
            a, b = int(w.first[d]), int(w.first[d + 1])
            lo, hi = max(a, p - side), min(b, p + size + side)
            out.append((d, int(f), p - a, n, w.joined(lo, p), w.joined(p, hi)))
    return out


def _documents(window: int, k: int, short: list[int], shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value

        def passes(fp: np.ndarray) -> np.ndarray:
            return in_bitmap(bits, (fp & np.uint64(FILTER_BITS - 1)).astype(np.int64))

        for batch in batches:
            for rows, offsets, data in T.row_chunks(batch):
                w = T.words(offsets, T.lower_ascii(data), T.ALNUM)
                hits: list[list] = [[] for _ in range(rows.num_rows)]
                for d, fp, pos, kind, before, after in _grams(w, window, k, short, False, passes):
                    hits[d].append({"fp": fp, "pos": pos, "kind": kind, "before": before, "after": after})
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(w.counts(), pa.int64()),
                     pa.array(hits, pa.list_(pa.struct([("fp", pa.int64()), ("pos", pa.int32()), ("kind", pa.int32()),
                                                        ("before", pa.string()), ("after", pa.string())])))],
                    names=["doc_id", "row_key", "n_words", "grams"])
    return run


def _items(window: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, offsets, data in T.row_chunks(batch):
                w = T.words(offsets, T.lower_ascii(data), T.ALNUM)
                got = _grams(w, window, k, list(range(1, window)), True, None)
                ids = rows.column(0).take(pa.array([g[0] for g in got], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([g[1] for g in got], pa.int64()), pa.array([g[4] for g in got], pa.string()), pa.array([g[5] for g in got], pa.string())],
                    names=["item_id", "fp", "item_before", "item_after"])
    return run


def _words(joined: str) -> list[str]:
    """Words of a context; they can hold any blank but the space, at which it is joined."""
    return joined.split(" ") if joined else []


def _common(x: list[str], y: list[str]) -> int:
    n = 0
    for p, q in zip(x, y):
        if p != q:
            break
        n += 1
    return n


def _extend(window: int, k: int):
    """Grow each joined k-gram over the equal words on both sides; keep whole windows."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            at, start, end = [], [], []
            for i, (kind, pos, before, after, item_before, item_after) in enumerate(
                    zip(f.kind, f.pos, f.before, f.after, f.item_before, f.item_after)):
                size = k if kind == window else kind
                right = _common(_words(after), _words(item_after))
                if right < size:
                    continue  # another k-gram with the same hash
                left = _common(_words(before)[::-1], _words(item_before)[::-1])
                if left + right >= kind:
                    at.append(i)
                    start.append(pos - left)
                    end.append(pos + right)
            yield pd.DataFrame({"doc_id": f.doc_id.iloc[at].array, "row_key": f.row_key.iloc[at].array,
                                "start": pd.array(start, "int32"), "end": pd.array(end, "int32"),
                                "items": f["items"].iloc[at].array})
    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """One row per document row: doc_id, row_key, n_words, n_hit, spans (the hit word ranges, merged
    and in order) and items (the ids of the items with an occurring window, as strings)."""
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    theirs = written(
        benchmark.select("item_id", F.col("text").cast("string").alias("text"))
        .mapInArrow(_items(window, k), f"item_id {item_type}, fp bigint, item_before string, item_after string")
        # one row for each context, with all items that hold it
        .groupBy("fp", "item_before", "item_after")
        .agg(F.collect_set(F.col("item_id").cast("string")).alias("items")), "benchmark-grams")
    lengths = (benchmark.select("text").mapInArrow(_short_lengths(window), "n int").distinct().toPandas())
    short = sorted(int(n) for n in lengths["n"])  # fewer than ``window`` values
    shared = spark.sparkContext.broadcast(
        bitmap(theirs.select(F.pmod("fp", F.lit(FILTER_BITS)).alias("slot"))))

    per_doc = written(
        docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), F.col("text").cast("string").alias("text"))
        .mapInArrow(_documents(window, k, short, shared),
                    f"doc_id {id_type}, row_key bigint, n_words bigint, "
                    "grams array<struct<fp:bigint,pos:int,kind:int,before:string,after:string>>"), "document-grams")
    joined = (per_doc.where(F.size("grams") > 0)
              .select("doc_id", "row_key", F.explode("grams").alias("g")).select("doc_id", "row_key", "g.*")
              .join(theirs, "fp")
              .select("doc_id", "row_key", "kind", "pos", "before", "after", "item_before", "item_after", "items"))
    hits = written(joined.mapInPandas(
        _extend(window, k), f"doc_id {id_type}, row_key bigint, start int, end int, items array<string>"), "hits")

    of_row = Window.partitionBy("row_key", "doc_id").orderBy("start", "end")
    islands = (hits.select("row_key", "doc_id", "start", "end").distinct()
               .withColumn("reach", F.max("end").over(of_row.rowsBetween(Window.unboundedPreceding, -1)))
               .withColumn("island", F.sum(F.when(F.col("start") <= F.col("reach"), 0).otherwise(1)).over(of_row))
               .groupBy("row_key", "doc_id", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
               .groupBy("row_key", "doc_id")
               .agg(F.sum(F.col("end") - F.col("start")).alias("n_hit"),
                    F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")))
    named = (hits.select("row_key", "doc_id", F.explode("items").alias("item"))
             .groupBy("row_key", "doc_id").agg(F.array_sort(F.collect_set("item")).alias("items")))
    same = ["row_key", "doc_id"]
    found = _null_safe(islands, named, same)
    return (_null_safe(per_doc.select("doc_id", "row_key", "n_words"), found, same)
            .select("doc_id", "row_key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                    F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join in which null keys equal each other."""
    r = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(r, on, "left").drop(*(f"_{k}" for k in keys))


def _short_lengths(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, offsets, data in T.row_chunks(batch):
                n = np.unique(T.words(offsets, T.lower_ascii(data), T.ALNUM).counts())
                yield pa.RecordBatch.from_arrays([pa.array(n[(n > 0) & (n < window)], pa.int32())], names=["n"])
    return run


def digest(result: DataFrame) -> DataFrame:
    """The columns of the query, from those of decontaminate()."""
    return result.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))
