"""Substring deduplication with suffix automata of reference shards, on words.

A word is removed when a window of ``window`` consecutive words that covers it also starts
in a document with a smaller doc_id. The steps:

1. Anchors: winnowing keeps the least K-word hash of every window, so every repeated window
   holds an anchor that all its occurrences hold at the same place. Hashes of anchors that
   occur more than once (counted over all documents) pass a bitmap to the next scan.
2. Contexts: around each such anchor lie all windows that hold it. Occurrences with an
   equal context as one in a smaller document have a reference there. Where one anchor
   has several contexts, their first documents compare windows by hash, and windows
   that occur in a smaller document have a reference there. This is all linear: a hot
   anchor is spread by its contexts' window hashes, never paired.
3. Reference shards: the referenced blocks of text, each in one shard of bounded size. Each
   shard's suffix automaton is built where the document segments that refer to it are
   gathered; segments of a popular shard are spread over several tasks that each get it.
   Streaming a segment through the automaton gives its matching statistics, word by
   word: the longest match that ends there, and the least doc_id that the last ``window``
   words occur in. Spans of at least ``window`` words from a smaller document go.

Hashes only choose where to look; the automata compare words.

Defined cases: null texts have no words; rows with null doc_id count as the last; rows
that share a doc_id don't remove from each other; repeated rows get the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.llm import text as T
from rateflow.llm.common import (WIDE_FILTER_BITS, bitmap, document_order, hash_filter, id_filter, in_bitmap, row_key, with_texts,
                                 written)

WINDOW = 50
K = 20
# Start positions of windows in one block of reference text or one segment.
BLOCK = 1024
# Window starts that a shard refers to, and that a task streams through it, on average.
SHARD = 24_000
STREAMED = 120_000


def _anchors(w: T.Words, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, anchor positions, anchor hashes)."""
    h = w.hashes()
    g = T.gram_hashes(h, k)
    at = T.winnow(g, w.first, k, window - k + 1)
    return h, at, g[at] if len(at) else np.zeros(0, np.uint64)


def _hashes(window: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, offsets, data in T.row_chunks(batch):
                _, _, h = _anchors(T.words(offsets, data, T.NOT_BLANK), window, k)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])
    return run


def _occurrences(window: int, k: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = window - k
        for batch in batches:
            for rows, offsets, data in T.row_chunks(batch):
                w = T.words(offsets, data, T.NOT_BLANK)
                values, at, h = _anchors(w, window, k)
                pick = in_bitmap(shared.value, (h & np.uint64(WIDE_FILTER_BITS - 1)).astype(np.int64))
                at, h = at[pick], h[pick]
                row = w.text[at]
                first = w.first[row]
                lo, hi = np.maximum(at - side, first), np.minimum(at + k + side, w.first[row + 1])
                ctx = T.span_hashes(values, lo, hi, 0xA24BAED4963EE407) ^ T.mix((at - lo).astype(np.uint64))
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(ctx.view(np.int64)), rows.column(0).take(take), rows.column(1).take(take),
                     pa.array((lo - first).astype(np.int32)), pa.array((hi - first - window).astype(np.int32))],
                    names=["h", "ctx", "row_key", "ord", "lo", "hi"])
    return run


def _windows(window: int):
    """Hashes of the windows that start in the given ranges (of starts, both included)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, offsets, data in T.row_chunks(batch):
                w = T.words(offsets, data, T.NOT_BLANK)
                values = w.hashes()
                starts, row = [], []
                for r, ranges in enumerate(rows.column(rows.schema.get_field_index("ranges")).to_pylist()):
                    s = np.unique(np.concatenate([np.arange(x["lo"], x["hi"] + 1) for x in ranges]))
                    starts.append(s)
                    row.append(np.full(len(s), r))
                s, row = np.concatenate(starts), np.concatenate(row)
                at = s + w.first[row]
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(T.span_hashes(values, at, at + window, 0x8CB92BA72F3D8DD7).view(np.int64)),
                     rows.column(0).take(take), rows.column(1).take(take), pa.array(s.astype(np.int32))],
                    names=["wh", "row_key", "ord", "start"])
    return run


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the ranges (lo to hi) of each text, for the shards named with them."""
    for batch in batches:
        for rows, offsets, data in T.row_chunks(batch):
            w = T.words(offsets, data, T.NOT_BLANK)
            row, out = [], []
            for r, parts in enumerate(rows.column(rows.schema.get_field_index("parts")).to_pylist()):
                a, b = int(w.first[r]), int(w.first[r + 1])
                for p in parts:
                    row.append(r)
                    out.append((p["shard"], p["salt"], p["reference"], p["lo"], w.joined(a + p["lo"], min(b, a + p["hi"]))))
            take, c = pa.array(row, pa.int64()), list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(take), rows.column(1).take(take), pa.array(c[0], pa.int64()), pa.array(c[1], pa.int32()),
                 pa.array(c[2], pa.bool_()), pa.array(c[3], pa.int32()), pa.array(c[4], pa.string())],
                names=["row_key", "ord", "shard", "salt", "reference", "lo", "words"])


class Automaton:
    """Suffix automaton of several word sequences, each with the order of its document."""

    def __init__(self, sequences: list[tuple[int, list[int]]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.least = [-1], [0], [1 << 63]
        for order, sequence in sequences:
            last = 0
            for c in sequence:
                last = self._extend(last, c, order)
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            p = self.link[v]
            if self.least[v] < self.least[p]:
                self.least[p] = self.least[v]

    def _clone(self, p: int, c: int, q: int) -> int:
        n = len(self.link)
        self.next.append(self.next[q].copy())
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.least.append(1 << 63)
        self.link[q] = n
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = n
            p = self.link[p]
        return n

    def _extend(self, last: int, c: int, order: int) -> int:
        q = self.next[last].get(c)
        if q is not None:  # from an earlier sequence
            v = q if self.length[q] == self.length[last] + 1 else self._clone(last, c, q)
            self.least[v] = min(self.least[v], order)
            return v
        n = len(self.link)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        self.least.append(order)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = n
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[n] = q if self.length[q] == self.length[p] + 1 else self._clone(p, c, q)
        return n

    def spans(self, sequence: list[int], order: int, window: int) -> list[tuple[int, int]]:
        """Maximal runs of windows of the sequence that a document before ``order`` holds."""
        out: list[tuple[int, int]] = []
        nexts, link, lengths, least = self.next, self.link, self.length, self.least
        v = n = 0
        for i, c in enumerate(sequence):
            while v and c not in nexts[v]:
                v = link[v]
                n = lengths[v]
            t = nexts[v].get(c)
            if t is None:
                n = 0
                continue
            v = t
            n += 1
            if n >= window:
                while lengths[link[v]] >= window:  # only the last words of the match matter
                    v = link[v]
                    n = lengths[v]
                if least[v] < order:
                    if out and out[-1][1] >= i + 1 - window:
                        out[-1] = (out[-1][0], i + 1)
                    else:
                        out.append((i + 1 - window, i + 1))
        return out


def _match(window: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        ids: dict[str, int] = {}
        reference = group[group["reference"]].sort_values(["ord", "row_key", "lo"])
        automaton = Automaton([(int(o), [ids.setdefault(x, len(ids)) for x in words.split(" ")])
                               for o, words in zip(reference["ord"], reference["words"])])
        out = []
        segments = group[~group["reference"]]
        for key, order, lo, words in zip(segments["row_key"], segments["ord"], segments["lo"], segments["words"]):
            for a, b in automaton.spans([ids.get(x, -1) for x in words.split(" ")], int(order), window):
                out.append((key, lo + a, lo + b))
        return pd.DataFrame(out, columns=["row_key", "start", "end"])
    return run


def repeated_spans(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """(row_key, spans): for each document row key with words to remove, their ranges in order,
    merged. See common.row_key()."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    texts = docs.select(row_key().alias("row_key"), document_order().alias("ord"), "text")
    twice = (docs.select("text").mapInArrow(_hashes(window, k), "h bigint")
             .groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    shared = spark.sparkContext.broadcast(
        bitmap(twice.select(F.pmod("h", F.lit(WIDE_FILTER_BITS)).alias("slot")), WIDE_FILTER_BITS))
    occurrences = written(texts.mapInArrow(
        _occurrences(window, k, shared), "h bigint, ctx bigint, row_key bigint, ord bigint, lo int, hi int"), "occurrences")

    # Of each context, an occurrence in the first document; of each anchor, how many contexts.
    contexts = written(occurrences.groupBy("h", "ctx").agg(
        F.min(F.struct("ord", "row_key", "lo")).alias("first"), F.max("ord").alias("last")), "contexts")
    anchors = written(contexts.groupBy("h").agg(F.count(F.lit(1)).alias("n_ctx"), F.min("first.ord").alias("least"), F.max("last").alias("last"))
                      .where("least < last").select("h", "n_ctx"), "anchors")
    contexts = written(contexts.join(anchors, "h").select("h", "ctx", "first", "n_ctx"), "repeated-contexts")
    known = written(occurrences.join(contexts, ["h", "ctx"]), "repeated-occurrences")

    # Starts lo to hi of windows of row_key occur from src_lo on in src_key, a smaller document.
    copies = known.where("ord > first.ord").select(
        "row_key", "ord", "lo", "hi", F.col("first.row_key").alias("src_key"), F.col("first.lo").alias("src_lo"))
    differing = (known.where("ord = first.ord and n_ctx > 1").groupBy("row_key")
                 .agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")))
    windows = written(with_texts(docs, differing, ["doc_id", "text"])
                      .select("row_key", document_order().alias("ord"), "text", "ranges")
                      .mapInArrow(_windows(window), "wh bigint, row_key bigint, ord bigint, start int"), "windows")
    # Few windows repeat; only those are gathered with where they are.
    twice = written(windows.groupBy("wh").agg(F.min("ord").alias("least"), F.max("ord").alias("last"))
                    .where("least < last").select("wh"), "repeated-windows")
    may_hold = hash_filter(twice, "wh")
    windows = written(windows.where(may_hold(F.col("wh"))), "windows")
    first = (windows.groupBy("wh").agg(F.min(F.struct("ord", "row_key", "start")).alias("first"), F.max("ord").alias("last"))
             .where("last > first.ord").select("wh", "first"))
    matched = windows.join(written(first, "first-windows"), "wh").where("ord > first.ord").select(
        "row_key", "ord", F.col("start").alias("lo"), F.col("start").alias("hi"),
        F.col("first.row_key").alias("src_key"), F.col("first.start").alias("src_lo"))
    routes = written(copies.unionByName(matched), "routes")

    # Blocks of reference text and the segments that refer to them, by shard.
    n = routes.agg(F.sum(F.col("hi") - F.col("lo") + 1)).first()[0] or 0
    shards = max(1, -(-n // SHARD))
    by_block = (routes.withColumn("src_hi", F.col("src_lo") + F.col("hi") - F.col("lo"))
                .withColumn("block", F.floor(F.col("src_lo") / BLOCK))
                .withColumn("shard", F.pmod(F.xxhash64("src_key", "block"), F.lit(shards))))
    blocks = by_block.groupBy(F.col("src_key").alias("row_key"), "shard", "block").agg(
        F.min("src_lo").alias("lo"), (F.max("src_hi") + window).alias("hi"))
    segments = written(by_block.groupBy("row_key", "shard", F.floor(F.col("lo") / BLOCK).alias("piece")).agg(
        F.min("lo").alias("lo"), (F.max("hi") + window).alias("hi")), "segments")
    salts = written(segments.groupBy("shard").agg(F.ceil(F.sum(F.col("hi") - F.col("lo")) / STREAMED).alias("salts")), "salts")
    spread = segments.join(salts, "shard").select(
        "row_key", "shard", F.pmod(F.xxhash64("row_key", "piece"), "salts").cast("int").alias("salt"), F.lit(False).alias("reference"), "lo", "hi")
    copied = blocks.join(salts, "shard").select(
        "row_key", "shard", F.explode(F.sequence(F.lit(0), F.col("salts").cast("int") - 1)).alias("salt"), F.lit(True).alias("reference"), "lo", "hi")
    instructions = written(spread.unionByName(copied).groupBy("row_key")
                           .agg(F.collect_list(F.struct("shard", "salt", "reference", "lo", "hi")).alias("parts")), "instructions")
    parts = (with_texts(docs, instructions, ["doc_id", "text"]).select("row_key", document_order().alias("ord"), "text", "parts")
             .mapInArrow(_parts, "row_key bigint, ord bigint, shard bigint, salt int, reference boolean, lo int, words string"))
    match = _match(window)
    spans = parts.groupBy("shard", "salt").applyInPandas(lambda g: match(g), "row_key bigint, start int, end int")
    return spans.distinct().groupBy("row_key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns row, text, spans -> row, n_words, n_removed, kept (null: nothing removed)."""
    for batch in batches:
        for rows, offsets, data in T.row_chunks(batch):
            raw, at = data.tobytes(), offsets.tolist()
            counts, removed, kept = [], [], []
            for a, b, spans in zip(at, at[1:], rows.column(rows.schema.get_field_index("spans")).to_pylist()):
                words = raw[a:b].split()  # at the six ASCII blanks
                left, end = [], 0
                for s in spans or ():
                    left += words[end: s["start"]]
                    end = max(end, s["end"])
                left += words[end:]
                counts.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["row", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, carry: list[str], window: int = WINDOW, k: int = K) -> DataFrame:
    """One row per document row: row (a struct of the columns in ``carry``), n_words, n_removed,
    kept (the words that stay, joined by one space)."""
    spans = written(repeated_spans(docs, window, k), "spans")
    may_hold = id_filter(spans, "row_key")
    rows = docs.select(F.struct(*carry).alias("row"), F.col("text").cast("string").alias("text"), row_key().alias("row_key"))
    none = F.lit(None).cast(spans.schema["spans"].dataType).alias("spans")
    row_type = rows.schema["row"].dataType.simpleString()
    found = rows.where(may_hold(F.col("row_key"))).join(spans, "row_key", "left").select("row", "text", "spans")
    rest = rows.where(~may_hold(F.col("row_key"))).select("row", "text", none)
    return found.unionByName(rest).mapInArrow(_cut, f"row {row_type}, n_words bigint, n_removed bigint, kept string")
