"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Documents become pieces of at most ``capacity`` tokens; pieces of one length are
interchangeable, so the packing is decided on the histogram of lengths (``capacity``
counts, whatever the number of documents) and carried out by rank: the r-th piece of a
length has a place that a table of rank ranges gives.

On the histogram, sets that dominate every other use of an item are fixed first:
* a piece that fills a sequence, or leaves less than the shortest piece needs, stays alone;
* two pieces that fill a sequence exactly belong together (any mates that they have
  elsewhere fit into the one other sequence that this frees);
* a piece whose room can't take two others gets the longest single one that fits.
The rules are repeated until none applies. The rest is packed best-fit, longest first, in
bulk: all open sequences of one free length are handled at once.

Defined cases: null and empty texts are one piece of the end token alone; repeated rows
are packed each; rows with null doc_id are packed too. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateflow.llm import text as T
from rateflow.llm.common import written
from rateflow.llm.tokenize import encoder

CAPACITY = 2048
END_ID = 0
# Pieces of one length that one task ranks together.
RANKED_TOGETHER = 200
# Buckets whose sizes are summed up by one task.
BUCKETS_TOGETHER = 4096


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _pieces(path: str | None, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path or default_vocabulary())
        end = np.array([end_id], "<u4").tobytes()
        step = 4 * capacity
        for batch in batches:
            for rows, offsets, data in T.row_chunks(batch):
                raw = data.tobytes()
                at = offsets.tolist()
                row, piece, length, crc, kept = [], [], [], [], []
                for r, ids in enumerate(words.encode([raw[a:b] for a, b in zip(at, at[1:])])):
                    ids += end
                    for i in range(0, len(ids), step):
                        part = ids[i: i + step]
                        row.append(r)
                        piece.append(i // step)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            kept.append(np.frombuffer(part, "<u4").astype(np.int32))
                p = np.array(piece, np.int32)
                columns = [rows.column(0).take(pa.array(row, pa.int64())), pa.array(p), pa.array(p.astype(np.int64) * capacity),
                           pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


class _Plan:
    """Rows (length, first rank, count, first sequence, offset): so many pieces of a length,
    by rank, go to consecutive sequences at one offset."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = {s: n for s, n in counts.items() if n > 0}
        self.sizes = sorted(self.left)
        self.next_rank = dict.fromkeys(self.left, 0)
        self.sequences = 0
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.capacity = capacity

    def _open(self, n: int) -> int:
        first = self.sequences
        self.sequences += n
        return first

    def _put(self, size: int, n: int, sequence: int, offset: int) -> None:
        self.rows.append((size, self.next_rank[size], n, sequence, offset))
        self.next_rank[size] += n
        self.left[size] -= n
        if not self.left[size]:
            del self.left[size]
            self.sizes.pop(bisect_left(self.sizes, size))

    def _fix(self, size: int) -> bool:
        """Fix the sequences of pieces of this size if one set dominates."""
        have, room = self.left[size], self.capacity - size
        others = self.sizes if have > 1 else [s for s in self.sizes if s != size]
        if not others or others[0] > room:
            # All of this size that there are, each alone; two of it never fit together.
            self._put(size, have, self._open(have), 0)
            return True
        mate = others[bisect_left(others, room + 1) - 1]
        second = others[0] if self.left[others[0]] - (others[0] == size) > 1 else (others[1] if len(others) > 1 else None)
        if mate != room and second is not None and others[0] + second <= room:
            return False
        # Using pieces up only makes the two shortest longer, so the rule holds n times.
        n = have // 2 if mate == size else min(have, self.left[mate])
        first = self._open(n)
        self._put(size, n, first, 0)
        self._put(mate, n, first, size)
        return True

    def reduce(self) -> None:
        again = True
        while again:
            again = False
            for size in reversed(list(self.sizes)):
                while size in self.left and self._fix(size):
                    again = True

    def best_fit(self) -> None:
        open_at: dict[int, list[tuple[int, int]]] = {}  # free length: ranges of sequences
        free: list[int] = []

        def add(room: int, first: int, n: int) -> None:
            if room and n:
                if room not in open_at:
                    insort(free, room)
                open_at.setdefault(room, []).append((first, n))

        for size in reversed(list(self.sizes)):
            while (count := self.left.get(size, 0)):
                i = bisect_left(free, size)
                if i < len(free):
                    room = free[i]
                    first, n = open_at[room].pop()
                    if not open_at[room]:
                        del open_at[room]
                        free.pop(i)
                else:
                    room, n = self.capacity, -(-count // (self.capacity // size))
                    first = self._open(n)
                each = room // size  # a sequence that takes one stays the tightest until full
                full = min(n, count // each)
                for layer in range(each if full else 0):
                    self._put(size, full, first, self.capacity - room + layer * size)
                add(room - each * size, first, full)
                rest = count - full * each
                if full < n and 0 < rest:
                    for layer in range(rest if rest < each else 0):
                        self._put(size, 1, first + full, self.capacity - room + layer * size)
                    add(room - rest * size, first + full, 1)
                    add(room, first + full + 1, n - full - 1)
                else:
                    add(room, first + full, n - full)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Placement rows (see _Plan) sorted by length and rank, and the number of sequences."""
    p = _Plan(counts, capacity)
    p.reduce()
    p.best_fit()
    rows = np.array(sorted(p.rows), np.int64).reshape(-1, 5)
    return rows, p.sequences


def _place(shared):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = shared.value
        keys = (rows[:, 0] << 48) | rows[:, 1]
        for f in frames:
            rank = f.pop("rank").to_numpy(np.int64)
            i = np.searchsorted(keys, (f["length"].to_numpy(np.int64) << 48) | rank, "right") - 1
            f["sequence_id"] = rows[i, 3] + rank - rows[i, 1]
            f["offset"] = rows[i, 4]
            yield f
    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and
    with ``with_ids`` the piece's ids. ``vocabulary``: the path of the vocabulary file."""
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
              + (", ids array<int>" if with_ids else ""))
    pieces = written(docs.select("doc_id", F.col("text").cast("string").alias("text"))
                     .mapInArrow(_pieces(vocabulary, capacity, end_id, with_ids), schema), "pieces")

    # capacity rows at most
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("of_length"))
    rows, _ = plan({int(r["length"]): int(r["of_length"]) for r in counts.toLocalIterator()}, capacity)
    shared = spark.sparkContext.broadcast(rows)

    # Ranks within a length: numbered in buckets of bounded size, then shifted by the
    # sizes of the buckets before.
    groups = F.ceil(F.col("of_length") / RANKED_TOGETHER)
    dealt = (pieces.join(F.broadcast(counts), "length")
             .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), groups))
             .drop("of_length"))
    # Sums in two levels: within blocks of buckets, and over a length's blocks.
    sizes = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("block", F.floor(F.col("bucket") / BUCKETS_TOGETHER))
    base = (sizes.groupBy("length", "block").agg(F.sum("n").alias("in_block"))
            .withColumn("base", F.sum("in_block").over(Window.partitionBy("length").orderBy("block")) - F.col("in_block")).drop("in_block"))
    before = (sizes.withColumn("shift", F.sum("n").over(Window.partitionBy("length", "block").orderBy("bucket")) - F.col("n"))
              .join(base, ["length", "block"]).select("length", "bucket", (F.col("shift") + F.col("base")).alias("shift")))
    ranked = (dealt.withColumn("i", F.row_number().over(
                  Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")))
              .join(before, ["length", "bucket"])
              .withColumn("rank", F.col("shift") + F.col("i") - 1)
              .select(*pieces.columns, "rank"))
    return ranked.mapInPandas(_place(shared), schema + ", sequence_id bigint, offset bigint")
