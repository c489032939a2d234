"""Near-duplicates by banded MinHash, with odd sketches that choose what is verified.

Documents are sets of word shingles; two are linked when their Jaccard similarity is at least
``percent`` / 100. Equal sets are one class, which takes part once.

Samples. A set has SAMPLES MinHash samples: in round i every shingle is thrown into a bin with a
value that begins with i, and a bin keeps its least value; from round SAMPLES on, round
SAMPLES + b throws into bin b alone. Later rounds can't win a filled bin, so a set is
done when all are full: about SAMPLES * log(SAMPLES) throws instead of SAMPLES for each
shingle. A bin agrees in two sets with the probability of their similarity.

Bands. BAND_ROWS samples make a band; classes that share a band are candidates. At the threshold
of 80 % two sets share none of the 51 bands with probability (1 - 0.8 ** 5) ** 51 < 2e-9.

Odd sketches. Each sample flips one of SKETCH_BITS bits. The XOR of two sketches has one bit for
each odd number of differing samples, and its population count x estimates the similarity as
1 + bits / (4 * samples) * ln(1 - 2 * x / bits). Pairs whose estimate is more than six standard
deviations below the threshold are not verified (``most_bits``); all others are, on whole sets.

Groups. A band's members are compared with its least member only (a star), so copies are never
expanded to pairs. The links found so far make trees; a band whose other members are all in one
tree is done. In the others, members of different trees are compared with each other inside a
task, by sketch and then by set: whole bands together, or by pairs of blocks where a band has
more than LEAF such members. Only links that join trees are returned. Equal sets of open
members of several bands are done once.

Defined cases: null texts and texts without words have an empty set and are linked with
nothing; fewer words than a shingle are one shingle; rows with null doc_id take part, and don't
give a component its id unless all have none; repeated rows get the same result. Extra columns
are ignored. Very long texts: a task holds the shingles of its longest single text, about 20
times its bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateflow.llm import text as T
from rateflow.llm.common import document_order, hash_filter, row_key, with_texts, written
from rateflow.llm.components import components
from rateflow.llm.jaccard import Sets

SHINGLE = 4
PERCENT = 80
SAMPLES = 256
BAND_ROWS = 5
SKETCH_BITS = 1024
LEAF = 500
# Shingles of the open bands that one task holds.
TOGETHER = 1_000_000

_U = np.uint64
_ROUND_BITS = 10
_EMPTY = _U(0xFFFFFFFFFFFFFFFF)


def samples(s: Sets, k: int = SAMPLES) -> np.ndarray:
    """The k samples (uint64) of each set, a row for each; rows of empty sets are all _EMPTY."""
    n_sets = len(s.first) - 1
    out = np.full(n_sets * k, _EMPTY, np.uint64)
    bins = _U(k - 1)
    open_ = s.sizes() > 0
    values, text = s.values, s.text
    for i in range(k):
        if not len(values):
            return out.reshape(n_sets, k)
        h = T.mix(values ^ _U((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        at = text * k + (h & bins).astype(np.int64)
        np.minimum.at(out, at, (h >> _U(_ROUND_BITS)) | (_U(i) << _U(64 - _ROUND_BITS)))
        full = (out.reshape(n_sets, k) != _EMPTY).all(1)
        if (full & open_).any():
            open_ &= ~full
            stay = open_[text]
            values, text = values[stay], text[stay]
    # Few sets of very few shingles: each empty bin has a round of its own.
    table = out.reshape(n_sets, k)
    for d in np.flatnonzero(open_).tolist():
        own = s.values[s.first[d]: s.first[d + 1]]
        empty = np.flatnonzero(table[d] == _EMPTY)
        seeds = (empty.astype(np.uint64) + _U(k + 1)) * _U(0x9E3779B97F4A7C15)
        h = T.mix(own[None, :] ^ seeds[:, None]).min(1)
        table[d, empty] = (h >> _U(_ROUND_BITS)) | (_U(k) << _U(64 - _ROUND_BITS))
    return table


def bands(table: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """Hashes of each set's bands; different bands never share a hash by their place."""
    out = []
    for b in range(table.shape[1] // rows):
        h = np.full(len(table), _U(b + 1))
        for c in range(b * rows, (b + 1) * rows):
            h = T.mix(h ^ table[:, c]) + _U(T._WORD_BASE)
        out.append(h)
    return np.column_stack(out) if out else np.zeros((len(table), 0), np.uint64)


def sketches(table: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """The odd sketch of each row of samples as bits // 64 words."""
    n, k = table.shape
    place = (T.mix(table + np.arange(k, dtype=np.uint64)[None, :] * _U(T._BYTE_BASE)) % _U(bits)).astype(np.int64)
    odd = np.zeros((n, bits), np.uint8)
    np.add.at(odd, (np.repeat(np.arange(n), k), place.ravel()), 1)
    return np.packbits(odd & 1, axis=1, bitorder="little").view(np.uint64)


def estimate(x: float, k: int = SAMPLES, bits: int = SKETCH_BITS) -> float:
    """Similarity from the population count of the XOR of two sketches."""
    return 1 + bits / (4 * k) * math.log(1 - 2 * x / bits) if 2 * x < bits else 0.0


def most_bits(percent: int, k: int = SAMPLES, bits: int = SKETCH_BITS, deviations: float = 6) -> int:
    """The largest population count at which a pair is verified: that of two sets at the threshold,
    plus so many standard deviations of the samples that differ and of their places."""
    differ = k * (1 - percent / 100)
    odd = (1 - math.exp(-4 * differ / bits)) / 2
    by_samples = 2 * math.sqrt(differ * percent / 100) * math.exp(-4 * differ / bits)
    by_places = math.sqrt(bits * odd * (1 - odd))
    return min(bits, math.ceil(bits * odd + deviations * math.hypot(by_samples, by_places)))


def _facts(size: int, k: int, rows: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, offsets, data in T.row_chunks(batch, size=1 << 19):
                s = Sets(offsets, data, size)
                table = samples(s, k)
                b, odd = bands(table, rows), sketches(table, bits)
                n = part.num_rows
                lists = (pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * x.shape[1]), pa.array(x.view(np.int64).ravel()))
                         for x in (b, odd))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(3)), pa.array(s.sizes(), pa.int64()),
                     pa.array(s.sums(0x1D8E4E27C47D124F).view(np.int64)), pa.array(s.sums(0x27220A95FE4BE3B5).view(np.int64)), *lists],
                    names=["doc_id", "row_key", "ord", "n", "s1", "s2", "bands", "odd"])
    return run


def _shingles(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, offsets, data in T.row_chunks(batch):
                s = Sets(offsets, data, size)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.ListArray.from_arrays(pa.array(s.first, pa.int32()), pa.array(s.values.view(np.int64)))],
                                                 names=["node", "shingles"])
    return run


class _Members:
    """Members of one task, with their sets as numbers of a common universe."""

    def __init__(self, g: pd.DataFrame):
        odd, sets = ([np.asarray(x, np.int64) for x in g[c]] for c in ("odd", "shingles"))
        self.nodes, self.label, self.odd = g["node"].to_numpy(), g["label"].to_numpy().copy(), np.stack(odd).view(np.uint64)
        self.sizes = np.array([len(x) for x in sets])
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        _, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(int(self.flat.max()) + 1, bool)

    def shared(self, p: int, others: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of p's set with those of others."""
        own = self.flat[self.first[p]: self.first[p + 1]]
        self.mark[own] = True
        if 2 * self.sizes[others].sum() > len(self.flat):
            both = np.add.reduceat(self.mark[self.flat], self.first[:-1], dtype=np.int64)[others]
        else:
            both = np.array([np.count_nonzero(self.mark[self.flat[self.first[q]: self.first[q + 1]]]) for q in others.tolist()])
        self.mark[own] = False
        return both

    def links(self, percent: int, most: int, first: int | None = None) -> list[tuple[int, int]]:
        """Links between members of different labels that join them. With ``first``, only pairs
        of one of the first so many members with one of the others."""
        out = []
        label, sizes = self.label, self.sizes
        for p in range(len(sizes) if first is None else first):
            low = p + 1 if first is None else first
            q = low + np.flatnonzero((label[low:] != label[p]) & (100 * np.minimum(sizes[low:], sizes[p]) >= percent * np.maximum(sizes[low:], sizes[p])))
            if len(q):
                q = q[np.bitwise_count(self.odd[q] ^ self.odd[p]).sum(1) <= most]
            if len(q):
                both = self.shared(p, q)
                for x in q[100 * both >= percent * (sizes[p] + sizes[q] - both)].tolist():
                    if label[x] != label[p]:
                        out.append((int(self.nodes[p]), int(self.nodes[x])))
                        label[label == label[x]] = label[p]
        return out


def _whole_bands(percent: int, most: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = [link for _, g in group.groupby("band", sort=False) for link in _Members(g.sort_values("node")).links(percent, most)]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")
    return run


def _blocks(percent: int, most: int):
    """One pair of blocks of a band: members with side 0 and with side 1 (none: one block alone)."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["side", "node"])
        first = None if g["i"].iat[0] == g["j"].iat[0] else int((g["side"] == 0).sum())
        return pd.DataFrame(_Members(g).links(percent, most, first), columns=["a", "b"], dtype="int64")
    return run


def _trees(links: DataFrame) -> DataFrame:
    """(node, label): nodes of one label are linked. Each node hangs on the least centre that it is
    linked with, which is less than itself; the label is the root of that tree."""
    state = written(links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label")), "trees")
    while True:
        above = state.select(F.col("node").alias("label"), F.col("label").alias("above"))
        state = written(state.join(above, "label", "left").select(
            "node", F.coalesce("above", "label").alias("label"), F.col("above").isNotNull().alias("moved")), "trees")
        if state.where("moved").isEmpty():
            return state.select("node", "label")
        state = state.select("node", "label")


def _star(rows: DataFrame, centres: DataFrame, sketch: DataFrame, percent: int, most: int) -> DataFrame:
    """(a, b): the centres and members of bands whose sketches and sizes let them be linked."""
    pairs = rows.join(centres, "band").where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    a, b = (sketch.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("odd").alias(f"odd_{c}")) for c in "ab")
    differ = F.aggregate(F.zip_with("odd_a", "odd_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    sized = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return pairs.join(a, "a").join(b, "b").where(sized & (differ <= most)).select("a", "b")


def _verified(pairs: DataFrame, sets_of, percent: int) -> DataFrame:
    """Of pairs (a, b), those that are linked by their whole sets."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = written(sets_of(written(nodes, "wanted")), "sets")
    both = (pairs.join(sets.withColumnsRenamed({"node": "a", "shingles": "x"}), "a")
            .join(sets.withColumnsRenamed({"node": "b", "shingles": "y"}), "b")
            .select("a", "b", (F.size("x") + F.size("y")).alias("n"), F.size(F.array_intersect("x", "y")).alias("both")))
    return both.where(100 * F.col("both") >= percent * (F.col("n") - F.col("both"))).select("a", "b")


def _within(members: DataFrame, sketch: DataFrame, sets_of, percent: int, most: int) -> list[DataFrame]:
    """Links of members (band, node, label) of different labels within each band."""
    member = F.xxhash64("node").cast("decimal(20,0)")
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.sum(member).alias("s"), F.min("node").alias("least"), F.max("node").alias("last"))
    # Bands of the same open members are done once.
    sizes = written(sizes.groupBy("size", "s", "least", "last").agg(F.min("band").alias("band")).select("band", "size"), "open-sizes")
    nodes = written(members.join(sizes, "band", "left_semi").select("node").distinct(), "wanted")
    whole = written(sets_of(nodes).join(sketch.select("node", "n", "odd"), "node"), "open-members")
    rows = written(members.join(sizes, "band").select("band", "size", "node", "label"), "open-rows")
    small = rows.where(F.col("size") <= LEAF)
    bins = max(1, -(-(small.join(sketch.select("node", "n"), "node").agg(F.sum("n")).first()[0] or 0) // TOGETHER))
    in_bands = _whole_bands(percent, most)
    found = [written(small.join(whole, "node").withColumn("bin", F.pmod(F.xxhash64("band"), F.lit(bins)))
                     .groupBy("bin").applyInPandas(lambda g: in_bands(g), "a bigint, b bigint"), "links")]
    large = rows.where(F.col("size") > LEAF)
    if not large.isEmpty():
        # Members outside a band's most frequent label meet each other and the rest, by blocks.
        counts = large.groupBy("band", "label").count()
        main = counts.groupBy("band").agg(F.max_by("label", F.struct("count", "label")).alias("main"), F.sum("count").alias("size"), F.max("count").alias("most"))
        main = written(main.select("band", "main", F.ceil(F.col("size") / LEAF).cast("int").alias("all"),
                                   F.ceil((F.col("size") - F.col("most")) / LEAF).cast("int").alias("others")), "blocks")
        told = F.col("label") == F.col("main")
        placed = large.select("band", "node", "label").join(main, "band").withColumn("told", told).withColumn(
            "block", F.when(told, F.col("others") + F.pmod(F.xxhash64("node"), "all")).otherwise(F.pmod(F.xxhash64("node"), "others")).cast("int"))
        last = F.col("others") + F.col("all") - 1
        one = placed.where("not told").select("band", "node", "label", F.lit(0).alias("side"), F.col("block").alias("i"), F.explode(F.sequence("block", last)).alias("j"))
        two = placed.select("band", "node", "label", F.lit(1).alias("side"),
                            F.explode(F.sequence(F.lit(0), F.least("block", F.col("others") - 1))).alias("i"), F.col("block").alias("j")).where("i <> j")
        in_blocks = _blocks(percent, most)
        found.append(written(one.unionByName(two).join(whole, "node").groupBy("band", "i", "j")
                             .applyInPandas(lambda g: in_blocks(g), "a bigint, b bigint"), "links"))
    return found


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, k: int = SAMPLES, rows: int = BAND_ROWS,
                    bits: int = SKETCH_BITS) -> DataFrame:
    """One row per document row: doc_id, row_key, n_shingles, component_id (the least doc_id that
    links lead to, its own included), kept (doc_id is that of the component). ``k`` and ``bits``
    are powers of two."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    facts = written(docs.select("doc_id", row_key().alias("row_key"), document_order().alias("ord"), "text")
                    .mapInArrow(_facts(size, k, rows, bits), f"doc_id {id_type}, row_key bigint, ord bigint, n bigint, s1 bigint, s2 bigint, "
                                "bands array<bigint>, odd array<bigint>"), "facts")
    kind = ["n", "s1", "s2"]
    classes = written(facts.where("n > 0").groupBy(*kind).agg(F.min(F.struct("ord", "row_key")).alias("first")), "classes")
    # Equal rows have one key: of those, any stands for its class.
    ones = (facts.where("n > 0").select("row_key", "n", "s1", "s2", "bands", "odd")
            .join(classes.select(*kind, F.col("first.row_key").alias("row_key")), [*kind, "row_key"], "left_semi"))
    reps = written(ones.select(F.col("row_key").alias("node"), "n", "bands", "odd").dropDuplicates(["node"]), "representatives")
    banded = reps.select("node", F.explode("bands").alias("band"))
    centres = written(banded.groupBy("band").agg(F.min("node").alias("centre"), F.max("node").alias("last")).where("centre < last")
                      .select("band", "centre"), "bands")
    may_be_shared = hash_filter(centres, "band")
    rows_ = written(banded.where(may_be_shared(F.col("band"))).join(centres, "band", "left_semi").select("band", "node"), "shared-bands")

    def sets_of(nodes: DataFrame) -> DataFrame:
        got = with_texts(docs, nodes.withColumnRenamed("node", "row_key"), ["text"]).dropDuplicates(["row_key"])
        return got.select("row_key", "text").mapInArrow(_shingles(size), "node bigint, shingles array<bigint>")

    sketch, most = reps.select("node", "n", "odd"), most_bits(percent, k, bits)
    near = written(_star(rows_, centres, sketch, percent, most), "near-pairs")
    found = [written(_verified(near, sets_of, percent), "links")]
    # A centre has met all members of its band; the others haven't met each other.
    labels = _trees(found[0])
    members = written(rows_.join(centres, "band").where("node <> centre").select("band", "node").join(labels, "node", "left")
                      .select("band", "node", F.coalesce("label", "node").alias("label")), "band-members")
    open_ = members.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("band")
    members = written(members.join(written(open_, "open-bands"), "band", "left_semi"), "open-members")
    if not members.isEmpty():
        found += _within(members, sketch, sets_of, percent, most)
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    parts = written(components(every), "components")
    joined = classes.select(*kind, "first").join(parts.select(F.col("node").alias("key"), "component"), F.col("first.row_key") == F.col("key"), "left")
    whole = written(joined.select(*kind, "first", F.coalesce("component", F.col("first.row_key")).alias("component")), "class-components")
    least = written(whole.groupBy("component").agg(F.min("first").alias("least")), "least")
    by_class = written(whole.join(least, "component").select(*kind, "least"), "class-ids")

    def number(order: Column) -> Column:
        return F.when(order == (1 << 63) - 1, F.lit(None)).otherwise(order).cast(id_type)

    found = facts.where("n > 0").join(by_class, kind).select("doc_id", "row_key", "n", number(F.col("least.ord")).alias("component_id"))
    empty = facts.where("n = 0").select("doc_id", "row_key", "n", F.col("doc_id").alias("component_id"))
    return found.unionByName(empty).select("doc_id", "row_key", F.col("n").alias("n_shingles"), "component_id",
                                           F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
