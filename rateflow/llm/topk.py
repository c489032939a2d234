"""Exact top-k inner-product search with a pivot-distance index.

Vectors are scaled to integers. One more component, sqrt(M - |x|^2) with M the largest
squared length (0 for queries), turns the largest inner product into the smallest
Euclidean distance, so the triangle inequality applies. Every row is indexed under its
nearest pivot (a cell) and its distance to it, in rings of equal width: an annulus. The
annuli of a query are ordered by the smallest distance that a member may have, from
|d(q, p) - d(x, p)| and from p being the nearest pivot of x. The first ones are searched
to get k results; then only those annuli whose bound could still beat the k-th score are.
A search compares a block of an annulus with a block of queries.

Only the pivots are fitted on a sample: SAMPLE rows at most, of the smallest id hashes.
They decide speed, not results. Pivots and ring widths are bounded in number
(MAX_PIVOTS, MAX_RINGS), so the table of annuli that every task gets has at most
MAX_PIVOTS * MAX_RINGS rows. Large annuli are split by id into blocks.

Defined cases: vectors that are null or hold a null or non-finite component, and rows
with a null id, take no part; an empty vector scores 0; shorter vectors count as padded
with zeros; candidates with the query's own id are its own row; equal query rows are one
query; fewer than k candidates give fewer results. Finite components so large that an inner
product might not fit in 64 bits are an error, as scores would be wrong. Extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateflow.llm.common import written

SCALE = 256
SAMPLE = 4096
MAX_PIVOTS = 256
MAX_RINGS = 256
# Rows of an index block and of a query block.
BLOCK = 2048
# Rows that the annuli of the first round hold at least.
FIRST_ROUND = 512


def _prepare(width: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            keep = np.logical_and(ids.is_valid().to_numpy(zero_copy_only=False), lists.is_valid().to_numpy(zero_copy_only=False))
            ids, lists = ids.filter(pa.array(keep)), lists.filter(pa.array(keep))
            n = len(ids)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            row = np.repeat(np.arange(n), sizes)
            column = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            bad = np.zeros(n, bool)
            bad[row[~np.isfinite(flat)]] = True
            x = np.zeros((n, width), np.int64)
            fine = np.isfinite(flat)
            # Products of two rows must fit in 64 bits.
            most = math.sqrt((1 << 62) / max(width, 1))
            if (np.abs(scale * flat[fine]) > most).any():
                raise ValueError(f"a component is beyond {most / scale:.4g}: inner products of such vectors don't fit in 64 bits")
            x[row[fine], column[fine]] = np.floor(scale * flat[fine]).astype(np.int64)
            x = x[~bad]
            yield pa.RecordBatch.from_arrays(
                [ids.filter(pa.array(~bad)).cast(pa.int64()), pa.array([v.tobytes() for v in x], pa.binary()), pa.array((x * x).sum(1))],
                names=["vec_id", "vec", "norm"])
    return run


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.int64).reshape(len(column), -1)


@dataclass
class Index:
    """Pivots (with the extra component), ring width and bounds of the scaled vectors."""

    pivots: np.ndarray
    width: float
    largest: int  # M

    def distances(self, x: np.ndarray, extra: np.ndarray) -> np.ndarray:
        full = np.column_stack([x.astype(np.float64), extra])
        d2 = (full ** 2).sum(1)[:, None] + (self.pivots ** 2).sum(1) - 2 * full @ self.pivots.T
        return np.sqrt(np.maximum(d2, 0))

    def members(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and ring of each vector."""
        d = self.distances(x, np.sqrt((self.largest - (x * x).sum(1)).astype(np.float64)))
        cell = d.argmin(1)
        ring = np.minimum(d[np.arange(len(x)), cell] / self.width, MAX_RINGS - 1).astype(np.int64)
        return cell, ring

    def best_scores(self, q: np.ndarray, cells: np.ndarray, rings: np.ndarray) -> np.ndarray:
        """For each query and annulus, a score that no member exceeds. The slack is far above
        the rounding of the distances."""
        d = self.distances(q, np.zeros(len(q)))
        own = d[:, cells]
        low = rings * self.width
        high = np.where(rings == MAX_RINGS - 1, np.inf, low + self.width)
        gap = np.maximum.reduce([own - high, low - own, (own - d.min(1)[:, None]) / 2, np.zeros_like(own)])
        slack = 1e-6 * (1 + math.sqrt(self.largest) + np.sqrt((q * q).sum(1)))[:, None]
        gap = np.maximum(gap - slack, 0)
        return ((q * q).sum(1)[:, None] + self.largest - gap ** 2) / 2


def _fit(sample: np.ndarray, n: int, largest: int) -> Index:
    """Pivots by a few rounds of k-means from spread starts, on the sample alone."""
    wanted = min(MAX_PIVOTS, len(sample), max(1, round(math.sqrt(2 * n / BLOCK))))
    full = np.column_stack([sample, np.sqrt((largest - (sample * sample).sum(1)).astype(np.float64))]).astype(np.float64)
    chosen = [0]
    near = ((full - full[0]) ** 2).sum(1)
    while len(chosen) < wanted and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((full - full[chosen[-1]]) ** 2).sum(1))
    pivots = full[chosen]
    for _ in range(5):
        d = (pivots ** 2).sum(1) - 2 * full @ pivots.T
        cell = d.argmin(1)
        pivots = np.array([full[cell == c].mean(0) if (cell == c).any() else pivots[c] for c in range(len(pivots))])
    index = Index(pivots, 1.0, largest)
    reach = index.distances(sample, full[:, -1]).min(1).max()
    rings = min(MAX_RINGS // 2, max(1, math.ceil(2 * n / (len(pivots) * BLOCK))))
    return Index(pivots, max(reach / rings, 1e-9), largest)


def _assign(shared):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                f["cell"], f["ring"] = shared.value.members(_matrix(f["vec"]))
                yield f[["vec_id", "vec", "cell", "ring"]]
    return run


def _route(shared, first_round: bool):
    """Each query with the annuli to search: those of the first round, or of the rest those
    that may hold a score of at least ``enough`` (null: all)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, cells, rings, sizes = shared.value
        for f in frames:
            for i in range(0, len(f), 256):
                part = f.iloc[i: i + 256]
                most = index.best_scores(_matrix(part["vec"]), cells, rings)
                order = np.argsort(-most, axis=1, kind="stable")
                before = np.cumsum(sizes[order], axis=1) - sizes[order]
                first = np.zeros_like(order, bool)
                np.put_along_axis(first, order, before < FIRST_ROUND, axis=1)
                if first_round:
                    pick = first
                else:
                    enough = part["enough"].to_numpy(np.float64, na_value=-np.inf)
                    pick = ~first & (most >= enough[:, None])
                r, a = np.nonzero(pick)
                yield pd.DataFrame({"query_id": part["query_id"].to_numpy()[r], "vec": part["vec"].to_numpy()[r],
                                    "cell": cells[a], "ring": rings[a]})
    return run


def _search(k: int):
    """The k best members of a block for each query of a block."""
    def run(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec": [], "vec_id": [], "score": []})
        ids, x = block["vec_id"].to_numpy(), _matrix(block["vec"])
        own, q = queries["query_id"].to_numpy(), _matrix(queries["vec"])
        if max(np.abs(x).max(initial=0), np.abs(q).max(initial=0)) <= 1 << 20 and x.shape[1] < 1 << 12:
            scores = (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)  # below 2**53: exact
        else:
            scores = q @ x.T
        other = ids[None, :] != own[:, None]
        # The k-th best of the others is no less than the (k + n)-th of all, if a query's own
        # id stands in n rows at most.
        worst = k + int(np.unique(ids, return_counts=True)[1].max())
        if len(ids) > worst:
            limit = np.partition(scores, len(ids) - worst, axis=1)[:, len(ids) - worst]
            other &= scores >= limit[:, None]
        r, c = np.nonzero(other)
        s = scores[r, c]
        order = np.lexsort((ids[c], -s, r))
        r, c, s = r[order], c[order], s[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        r, c, s = (v[place < k] for v in (r, c, s))
        return pd.DataFrame({"query_id": own[r], "vec": queries["vec"].to_numpy()[r], "vec_id": ids[c], "score": s})
    return run


_FOUND = "query_id bigint, vec binary, vec_id bigint, score bigint"


def top_k(embeddings: DataFrame, queries: str, k: int = 5, scale: int = SCALE) -> DataFrame:
    """The k best other rows for each row that the SQL condition ``queries`` (on vec_id)
    selects: query_id, rank, vec_id, score. embeddings: vec_id, embedding."""
    spark = embeddings.sparkSession
    width = embeddings.agg(F.max(F.size("embedding"))).first()[0] or 0
    rows = written(embeddings.select("vec_id", "embedding")
                   .mapInArrow(_prepare(max(width, 1), scale), "vec_id bigint, vec binary, norm bigint"), "vectors")
    n, largest = rows.agg(F.count(F.lit(1)), F.coalesce(F.max("norm"), F.lit(0))).first()
    asked = rows.where(queries).select(F.col("vec_id").alias("query_id"), "vec").distinct()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    sample = _matrix(rows.orderBy(F.xxhash64("vec_id"), "vec_id").select("vec").limit(SAMPLE).toPandas()["vec"])
    index = _fit(sample, n, int(largest))

    placed = written(rows.mapInPandas(_assign(spark.sparkContext.broadcast(index)), "vec_id bigint, vec binary, cell int, ring int"), "index")
    annuli = placed.groupBy("cell", "ring").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values(["cell", "ring"])
    shared = spark.sparkContext.broadcast((index, *(annuli[c].to_numpy(np.int64) for c in ("cell", "ring", "n"))))
    # MAX_PIVOTS * MAX_RINGS rows at most
    sizes = F.broadcast(spark.createDataFrame(annuli.assign(blocks=-(-annuli["n"] // BLOCK))[["cell", "ring", "blocks"]]))
    asked = written(asked, "queries")
    n_asked = asked.count()
    query_blocks = max(1, -(-n_asked // BLOCK))

    def search(routed: DataFrame) -> DataFrame:
        key = ["cell", "ring", "block", "query_block"]
        left = (placed.join(sizes, ["cell", "ring"])
                .withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks"))
                .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
                .select(*key, "vec_id", "vec").alias("index"))
        right = (routed.join(sizes, ["cell", "ring"])
                 .withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
                 .withColumn("query_block", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int"))
                 .select(*key, "query_id", "vec").alias("asked"))
        return (left.groupBy(*(F.col(f"index.{c}") for c in key)).cogroup(right.groupBy(*(F.col(f"asked.{c}") for c in key)))
                .applyInPandas(lambda a, b: _search(k)(a, b), _FOUND))

    best = Window.partitionBy("query_id", "vec").orderBy(F.desc("score"), "vec_id")

    def first(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    route = "query_id bigint, vec binary, cell int, ring int"
    early = written(first(search(asked.mapInPandas(_route(shared, True), route))), "first-round")
    bounds = early.where(F.col("rank") == k).select("query_id", "vec", F.col("score").alias("enough"))
    rest = search(asked.join(bounds, ["query_id", "vec"], "left").mapInPandas(_route(shared, False), route))
    return first(early.drop("rank").unionByName(rest)).select("query_id", "rank", "vec_id", "score")
