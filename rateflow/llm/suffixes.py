"""Exact byte deduplication by a distributed merge sort of suffixes.

A byte is removed when a string of ``window`` bytes that covers it also starts earlier, in
a smaller document or earlier in its own. Only suffixes at anchors are sorted: winnowing
keeps the least K-byte hash of every window, so a repeated window holds an anchor that all
its occurrences hold at the same place, and only anchors that occur more than once (over
all documents, by a bitmap of their hashes) go on.

* An occurrence whose whole context (all windows that hold the anchor) equals an earlier
  one is covered by it. One occurrence of each context stays.
* Where an anchor has several contexts, their suffixes are sorted: by the bytes from the
  anchor on, then by the bytes before it, read backwards. Each task sorts the suffixes of
  its texts into runs and hands them over front-coded, by ranges of suffixes. A range's
  runs are combined by a loser tree that knows each head's common prefix with the last
  winner and compares only bytes beyond it; this also gives the common prefixes of
  neighbours in the merged order.
* For each number o of bytes before the anchor, suffixes whose neighbours share
  window - o bytes form groups; those that agree in the o bytes before hold the same window.
  All but the earliest are covered.

Anchors are spread over ranges by hash. One with very many contexts (a passage that many
documents share) has its suffixes split into several ranges by a sample of them (at most
1/MAX_HOT of all contexts share a range otherwise); groups that touch an inner border of
such ranges hand over their earliest windows, and these are compared by hash.

Defined cases: null texts are empty; rows with null doc_id come last; rows that share a
doc_id are ordered by a hash of their text; equal rows are one document and get the same
result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.llm import text as T
from rateflow.llm.common import (WIDE_FILTER_BITS, bitmap, document_order, id_filter, in_bitmap, row_key, with_texts,
                                 written)

WINDOW = 100
K = 36
# Suffixes of one range, and the number of anchors that may be split over ranges.
RANGE = 8_000
MAX_HOT = 4096
SAMPLED = 64
# Suffixes that a task sorts into one set of runs.
RUN = 200_000

_HEAD = 8  # each key begins with its anchor's hash


def _anchors(offsets: np.ndarray, data: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, position, hash) of the anchors."""
    values = T._BYTE_VALUES[data]
    g = T.gram_hashes(values, k)
    at = T.winnow(g, offsets, k, window - k + 1)
    return np.searchsorted(offsets, at, "right") - 1, at, g[at] if len(at) else np.zeros(0, np.uint64)


def _hashes(window: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, offsets, data in T.row_chunks(batch):
                h, n = np.unique(_anchors(offsets, data, window, k)[2], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])
    return run


def _merged(row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching ranges of each row as one; sorted by row and start."""
    if not len(row):
        return row, lo, hi
    order = np.lexsort((lo, row))
    row, lo, hi = row[order], lo[order], hi[order]
    shift = row * (int(hi.max()) + 2)
    reach = np.maximum.accumulate(hi + shift)
    new = np.concatenate([[True], (lo + shift)[1:] > reach[:-1]])
    heads = np.flatnonzero(new)
    return row[heads], lo[heads], np.maximum.reduceat(hi + shift, heads) - shift[heads]


def _occurrences(window: int, k: int, shared):
    """The first occurrence of each context in a text; for texts that repeat contexts of
    their own, also the ranges that the later ones cover (rows with null h)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = window - k
        for batch in batches:
            for rows, offsets, data in T.row_chunks(batch):
                row, at, h = _anchors(offsets, data, window, k)
                pick = in_bitmap(shared.value, (h & np.uint64(WIDE_FILTER_BITS - 1)).astype(np.int64))
                row, at, h = row[pick], at[pick], h[pick]
                first = offsets[row]
                lo, hi = np.maximum(at - side, first), np.minimum(at + window, offsets[row + 1])
                ctx = T.byte_span_hashes(data, lo, hi) ^ T.mix((at - lo).astype(np.uint64))
                order = np.lexsort((at, ctx, row))
                r, c = row[order], ctx[order]
                again = np.concatenate([[False], (r[1:] == r[:-1]) & (c[1:] == c[:-1])])
                later, once = order[again], order[~again]
                c_row, c_lo, c_hi = _merged(row[later], lo[later], hi[later])
                n = len(c_row)
                take = pa.array(np.concatenate([row[once], c_row]), pa.int64())
                absent = np.concatenate([np.zeros(len(once), bool), np.ones(n, bool)])
                base = np.concatenate([first[once], offsets[c_row]])

                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([h[once].view(np.int64), np.zeros(n, np.int64)]), mask=absent),
                     pa.array(np.concatenate([ctx[once].view(np.int64), np.zeros(n, np.int64)])), rows.column(0).take(take), rows.column(1).take(take),
                     pa.array((np.concatenate([at[once], c_lo]) - base).astype(np.int32)),
                     pa.array((np.concatenate([lo[once], c_lo]) - base).astype(np.int32)),
                     pa.array((np.concatenate([hi[once], c_hi]) - base).astype(np.int32))],
                    names=["h", "ctx", "row_key", "ord", "at", "lo", "hi"])
    return run


def _key(h: int, data: bytes, at: int, lo: int, hi: int) -> bytes:
    return (h & (1 << 64) - 1).to_bytes(_HEAD, "big") + data[at:hi] + data[lo:at][::-1]


def _sample_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h, keys = [], []
        for text, wanted in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("wanted").to_pylist()):
            for s in wanted:
                h.append(s["h"])
                keys.append(_key(s["h"], text, s["at"], s["lo"], s["hi"]))
        yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(keys, pa.binary())], names=["h", "key"])


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of a and b, of which ``known`` bytes are known."""
    n = min(len(a), len(b))
    i = known
    while i < n:
        if a[i: i + 24] == b[i: i + 24]:
            i += 24
            continue
        while i < n and a[i] == b[i]:
            i += 1
        return i
    return n


def front_code(keys: list[bytes]) -> tuple[np.ndarray, bytes, np.ndarray]:
    """(common prefix with the key before, the bytes after it, their lengths) of sorted keys."""
    shared, tails, last = [], [], b""
    for key in keys:
        n = common_prefix(last, key)
        shared.append(n)
        tails.append(key[n:])
        last = key
    return np.array(shared, np.uint16), b"".join(tails), np.array([len(t) for t in tails], np.uint16)


def decode_run(shared: np.ndarray, tails: bytes, lengths: np.ndarray) -> Iterator[tuple[bytes, int]]:
    """(key, its common prefix with the key before) in order."""
    last, at = b"", 0
    for n, m in zip(shared.tolist(), lengths.tolist()):
        last = last[:n] + tails[at: at + m]
        at += m
        yield last, n


def merge_runs(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[int, bytes, int]]:
    """Merge sorted runs: (run, key, common prefix with the key given before).

    A loser tree in which each run's head carries its common prefix with the last winner.
    Of two heads the one with the longer prefix is the smaller; equal ones are compared
    from that prefix on, and the loser keeps what the two then turn out to share."""
    count = len(runs)
    size = 1 << max(0, count - 1).bit_length()
    head: list[bytes | None] = [None] * size  # None: exhausted, sorts last
    prefix = [0] * size
    for i, run in enumerate(runs):
        got = next(run, None)
        head[i] = got[0] if got else None
    loser = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); ties go to the run of smaller number."""
        x, y = head[a], head[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        p, q = prefix[a], prefix[b]
        if p > q:
            return a, b
        if q > p:
            return b, a
        n = common_prefix(x, y, p)
        if n == len(x) and n == len(y):
            a_first = a < b
        else:
            a_first = n == len(x) or (n < len(y) and x[n] < y[n])
        if a_first:
            prefix[b] = n
            return a, b
        prefix[a] = n
        return b, a

    def build(node: int) -> int:
        if node >= size:
            return node - size
        w, l = play(build(2 * node), build(2 * node + 1))
        loser[node] = l
        return w

    winner = build(1) if size > 1 else 0
    while head[winner] is not None:
        yield winner, head[winner], prefix[winner]
        got = next(runs[winner], None)
        if got is None:
            head[winner] = None
        else:
            head[winner], prefix[winner] = got  # its prefix with its run's last key, the winner
        node = (winner + size) >> 1
        while node:
            winner, loser[node] = play(winner, loser[node])
            node >>= 1


def _runs(bins: int, shared):
    """Sorted, front-coded runs of the suffixes of a task's texts, by range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitters = shared.value
        held: dict[tuple[int, int], list[tuple]] = {}
        size = 0

        def handed_over() -> Iterator[pa.RecordBatch]:
            for (b, s), items in held.items():
                items.sort()
                shares, tails, lengths = front_code([x[0] for x in items])
                numbers = np.array([x[1:] for x in items], np.int64)  # after, before, ord, row_key, at
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int64()), pa.array([s], pa.int32()), pa.array([shares.tobytes()], pa.binary()),
                     pa.array([tails], pa.binary()), pa.array([lengths.tobytes()], pa.binary()), pa.array([numbers.tobytes()], pa.binary())],
                    names=["bin", "part", "shares", "tails", "lengths", "numbers"])
            held.clear()

        for batch in batches:
            for key, order, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("row_key", "ord")),
                                                batch.column("text").cast(pa.binary()).to_pylist(), batch.column("wanted").to_pylist()):
                for w in wanted:
                    h, at, lo, hi = w["h"], w["at"], w["lo"], w["hi"]
                    k = _key(h, text, at, lo, hi)
                    cuts = splitters.get(h)
                    part = (h % bins, 0) if cuts is None else (h, 1 + bisect_right(cuts, k))
                    held.setdefault(part, []).append((k, hi - at, at - lo, order, key, at))
                size += len(wanted)
                if size >= RUN:
                    yield from handed_over()
                    size = 0
        yield from handed_over()
    return run


def _window_hash(key: bytes, after: int, o: int, need: int) -> int:
    """Hash of the window of o bytes before the anchor and ``need`` from it on."""
    begin = _HEAD + after
    window = key[begin: begin + o][::-1] + key[_HEAD: _HEAD + need]
    return int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "big", signed=True)


def _covered(window: int, k: int, shared):
    """Merge the runs of a range and find the windows that have an earlier occurrence: ranges
    of covered bytes, and (with wh) the earliest windows of groups at an inner border."""
    side = window - k

    def run(group: pd.DataFrame) -> pd.DataFrame:
        numbers = [np.frombuffer(x, np.int64).reshape(-1, 5) for x in group["numbers"]]
        coded = [decode_run(np.frombuffer(s, np.uint16), t, np.frombuffer(n, np.uint16))
                 for s, t, n in zip(group["shares"], group["tails"], group["lengths"])]
        taken = [0] * len(coded)
        rows, lcp, keys = [], [], []
        for r, key, shared_bytes in merge_runs(coded):
            rows.append(numbers[r][taken[r]])
            taken[r] += 1
            lcp.append(shared_bytes - _HEAD)
            keys.append(key)
        n = len(rows)
        after, before, order, row_keys, at = np.array(rows, np.int64).T
        lcp = np.array(lcp)
        lcp[0] = -1
        back = np.frombuffer(b"".join(x[_HEAD + a: _HEAD + a + side].ljust(side, b"\0") for x, a in zip(keys, after.tolist())),
                             np.uint8).reshape(n, side)
        # Equal rows have equal keys, and their suffixes equal ranks.
        by = np.lexsort((at, row_keys, order))
        rank = np.empty(n, np.int64)
        rank[by] = np.cumsum(np.append(0, (np.diff(at[by]) != 0) | (np.diff(row_keys[by]) != 0) | (np.diff(order[by]) != 0)))
        least, most = np.full(n, side + 1), np.full(n, -1)
        # Ranges of a split anchor have inner borders, below and above.
        part = int(group["part"].iat[0])
        low_open = part > 1
        high_open = 0 < part <= len(shared.value.get(int(group["bin"].iat[0]), ()))
        # A splitter is itself the first key of the range above.
        next_shares = common_prefix(keys[-1], shared.value[int(group["bin"].iat[0])][part - 1]) - _HEAD if high_open else -1
        open_at: list[np.ndarray] = []
        open_before: list[np.ndarray] = []
        hashed = np.zeros(n, np.uint64)
        for o in range(side + 1):
            if o:
                hashed = hashed * np.uint64(T._BYTE_BASE) + T._BYTE_VALUES[back[:, o - 1]]
            need = window - o
            number = np.cumsum(lcp < need)
            fit = np.flatnonzero((after >= need) & (before >= o))
            if not len(fit):
                continue
            same = T.mix(hashed ^ T.mix(number.astype(np.uint64)))
            by = fit[np.argsort(same[fit])]
            heads = np.flatnonzero(np.concatenate([[True], same[by][1:] != same[by][:-1]]))
            best = np.minimum.reduceat(rank[by], heads)
            late = rank[by] > np.repeat(best, np.diff(np.append(heads, len(by))))
            hit = by[late]
            least[hit] = np.minimum(least[hit], o)
            most[hit] = o
            earliest = by[~late]
            # Whatever shares ``need`` bytes may go on beyond the border, also past ranges whose
            # suffixes all share the whole window: every earliest window of the group is handed over.
            touched = np.zeros(len(earliest), bool)
            if low_open:
                touched |= number[earliest] == number[0]
            if high_open and next_shares >= need:
                touched |= number[earliest] == number[n - 1]
            if touched.any():
                open_at.append(earliest[touched])
                open_before.append(np.full(len(open_at[-1]), o))
        hit = np.flatnonzero(most >= 0)
        out = pd.DataFrame({"row_key": row_keys[hit], "ord": order[hit], "lo": at[hit] - most[hit], "hi": at[hit] - least[hit] + window,
                            "wh": pd.array([None] * len(hit), "Int64")})
        if open_at:
            i, o = np.concatenate(open_at), np.concatenate(open_before)
            more = pd.DataFrame({"row_key": row_keys[i], "ord": order[i], "lo": at[i] - o, "hi": at[i] - o + window, "wh": pd.array(
                [_window_hash(keys[x], int(after[x]), y, window - y) for x, y in zip(i.tolist(), o.tolist())], "Int64")})
            out = pd.concat([out, more])
        return out
    return run


def repeated_ranges(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """(row_key, ranges): byte ranges to remove of each document row key, unmerged."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    texts = docs.select(row_key().alias("row_key"), document_order().alias("ord"), "text")
    twice = (docs.select("text").mapInArrow(_hashes(window, k), "h bigint, n bigint")
             .groupBy("h").agg(F.sum("n").alias("n")).where("n > 1"))
    shared = spark.sparkContext.broadcast(
        bitmap(twice.select(F.pmod("h", F.lit(WIDE_FILTER_BITS)).alias("slot")), WIDE_FILTER_BITS))
    found = written(texts.mapInArrow(
        _occurrences(window, k, shared), "h bigint, ctx bigint, row_key bigint, ord bigint, at int, lo int, hi int"), "occurrences")
    occurrences = found.where("h is not null")

    contexts = written(occurrences.groupBy("h", "ctx").agg(
        F.min(F.struct("ord", "row_key", "at", "lo", "hi")).alias("first"), F.count(F.lit(1)).alias("n")), "contexts")
    repeated = contexts.where("n > 1").select("h", "ctx", "first")
    copies = (occurrences.join(repeated, ["h", "ctx"]).where(F.struct("ord", "row_key", "at") > F.struct("first.ord", "first.row_key", "first.at"))
              .select("row_key", "lo", "hi"))

    several = written(contexts.groupBy("h").agg(F.count(F.lit(1)).alias("n_ctx")).where("n_ctx > 1"), "anchors")
    total = several.agg(F.sum("n_ctx")).first()[0] or 0
    limit = max(RANGE // 4, total // MAX_HOT)
    hot = several.where(F.col("n_ctx") > limit)
    several_contexts = written(contexts.join(several, "h").select("h", "ctx", "n_ctx", "first.*"), "suffixes")
    sample = (several_contexts.where(F.col("n_ctx") > limit)
              .where(F.pmod(F.xxhash64("ctx"), F.ceil(F.col("n_ctx") / SAMPLED)) == 0)
              .groupBy("row_key").agg(F.collect_list(F.struct("h", "at", "lo", "hi")).alias("wanted")))
    # MAX_HOT anchors at most, with about SAMPLED keys each.
    counts = {r["h"]: r["n_ctx"] for r in hot.collect()}
    splitters: dict[int, list[bytes]] = {}
    if counts:
        keys: dict[int, list[bytes]] = {}
        sampled = with_texts(docs, written(sample, "sample"), ["text"]).select("text", "wanted").mapInArrow(_sample_keys, "h bigint, key binary")
        for r in sampled.toLocalIterator():
            keys.setdefault(r["h"], []).append(bytes(r["key"]))
        for h, ks in keys.items():
            ks.sort()
            parts = min(-(-counts[h] // limit), len(ks))
            splitters[h] = sorted({ks[i * len(ks) // parts] for i in range(1, parts)})
    split = spark.sparkContext.broadcast(splitters)

    wanted = written(several_contexts.groupBy("row_key")
                     .agg(F.collect_list(F.struct("h", "at", "lo", "hi")).alias("wanted")), "wanted")
    runs = (with_texts(docs, wanted, ["doc_id", "text"]).select("row_key", document_order().alias("ord"), "text", "wanted")
            .mapInArrow(_runs(max(1, -(-total // RANGE)), split),
                        "bin bigint, part int, shares binary, tails binary, lengths binary, numbers binary"))
    covered = _covered(window, k, split)
    merged = written(runs.groupBy("bin", "part").applyInPandas(
        lambda g: covered(g), "row_key bigint, ord bigint, lo int, hi int, wh bigint"), "merged")
    at_borders = merged.where("wh is not null")
    earliest = (at_borders.groupBy("wh").agg(F.min(F.struct("ord", "row_key", "lo")).alias("first"), F.count(F.lit(1)).alias("n"))
                .where("n > 1").select("wh", "first"))
    across = (at_borders.join(written(earliest, "borders"), "wh")
              .where(F.struct("ord", "row_key", "lo") > F.struct("first.ord", "first.row_key", "first.lo")).select("row_key", "lo", "hi"))
    ranges = (found.where("h is null").select("row_key", "lo", "hi").unionByName(copies)
              .unionByName(merged.where("wh is null").select("row_key", "lo", "hi")).unionByName(across))
    return ranges.groupBy("row_key").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, offsets, data in T.row_chunks(batch):
            at = offsets.tolist()
            sizes, removed, spans, kept = [], [], [], []
            for a, b, ranges in zip(at, at[1:], rows.column(rows.schema.get_field_index("ranges")).to_pylist()):
                lo = np.array([r["lo"] for r in ranges or ()], np.int64)
                hi = np.array([r["hi"] for r in ranges or ()], np.int64)
                _, lo, hi = _merged(np.zeros(len(lo), np.int64), lo, hi)
                cuts = [0, *np.column_stack([lo, hi]).ravel().tolist(), b - a]
                sizes.append(b - a)
                removed.append(int((hi - lo).sum()))
                spans.append(len(lo))
                kept.append(b"".join(data[a + i: a + j].tobytes() for i, j in zip(cuts[::2], cuts[1::2])))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                names=["row", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, carry: list[str], window: int = WINDOW, k: int = K) -> DataFrame:
    """One row per document row: row (a struct of the columns in ``carry``), n_bytes, n_removed,
    n_spans, kept (the bytes that stay; a cut may fall inside a character)."""
    ranges = written(repeated_ranges(docs, window, k), "ranges")
    may_hold = id_filter(ranges, "row_key")
    rows = docs.select(F.struct(*carry).alias("row"), F.col("text").cast("string").alias("text"), row_key().alias("row_key"))
    none = F.lit(None).cast(ranges.schema["ranges"].dataType).alias("ranges")
    found = rows.where(may_hold(F.col("row_key"))).join(ranges, "row_key", "left").select("row", "text", "ranges")
    rest = rows.where(~may_hold(F.col("row_key"))).select("row", "text", none)
    row_type = rows.schema["row"].dataType.simpleString()
    return found.unionByName(rest).mapInArrow(
        _cut, f"row {row_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
