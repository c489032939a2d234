"""Exact Jaccard similarity join as a metric-space join, with connected components.

Documents are sets of word shingles; two are linked when their Jaccard similarity is at
least ``percent`` / 100, that is within distance r = 1 - percent / 100. Equal sets are one
class, joined once.

First level. Unrelated texts lie at distance 1 from each other and from any pivot, so
pivots alone can't tell them apart. The first regions therefore come from an exact sieve:
within distance r, a set of n elements differs from another in at most n * r / (1 - r) of them, so
if it has more parts than that (by hash), one at least is equal on both sides. Sets that
share such a part (by its signature, for their size class or the next smaller one) belong to one
coarse region: a connected component of these shares. Unrelated texts fall out here. Parts
of no or one element say little and don't count; sets are divided into so many parts that those
of two or more elements alone nearly always outnumber the differences. A set where they don't
needs another sign only with sets of the same kind: small ones a little-saying part together
with a part of a second, independent division; larger ones one of their first n * r + 1 elements
in the order of hashes, of which linked sets have one in common. So signatures are fewer than
elements however long a text is.

Pivots. Large regions are joined in rounds: some members become pivots and every member
gets its distances to them. Members within r of a pivot are linked to it. The pivots' Voronoi
cells make the next regions: a member goes to its nearest pivot's cell, and, as a linked
member of another cell can't be further than 2r beyond, to every cell within that window;
those far from all pivots share a cell. Pivots are done, and so are cells whose members
are already one component. Regions of at most LEAF classes are joined exactly: member by
member as a pivot, skipping members of its own component and those that the triangle
inequality excludes by earlier distances. A large region that its cells don't divide (all
members lie within each other's windows, or none is near another), or that is left after ROUNDS
rounds, is joined by its signatures: only members that share one can be linked, and each set of members
that share one is a region of its own. Regions of sets that are alike by chance are chains of such
shares, with few pairs that share one. Where members would be sent oftener that way than by pairs of
blocks (texts that are alike below the threshold share very many), it is joined by pairs of blocks.

Signatures are shuffled once, packed, and not stored: a task sends each one once with its least
node, and the links to that node of the others that it has.

Only links that join components are reported, so copies are never expanded to pairs.

Defined cases: null texts and texts without words have an empty set and are linked with
nothing; fewer words than a shingle are one shingle; rows with null doc_id take part, and
don't give a component its id unless all have none; repeated rows get the same result. Extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rateflow.llm import text as T
from rateflow.llm.common import document_order, drop_rows, id_filter, row_key, with_texts, written
from rateflow.llm.components import components

SHINGLE = 3
PERCENT = 90
LEAF = 500
PIVOTS = 24
ROUNDS = 3
# Members that one task compares with a region's pivots, and classes of leaves together.
TOGETHER = 1000
FAR = 0.5
# Sets of up to so many parts are divided a second time where a part says little.
FEW_PARTS = 32
# Signatures that a task packs together, and at most about as many as a shard gets. Of a signature,
# LOW_BITS are sent; they follow those that number the shards.
PACKED = 1 << 20
LOW_BITS = 48

_U = np.uint64


class Sets:
    """Distinct shingle hashes of a few texts, sorted within each text."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, size: int):
        w = T.words(offsets, T.lower_ascii(data), T.NOT_BLANK)
        h, counts = w.hashes(), w.counts()
        at = T.gram_positions(w.first, size)
        long_hashes = T.gram_hashes(h, size)[at] if len(at) else np.zeros(0, np.uint64)
        few = np.flatnonzero((counts > 0) & (counts < size))
        short = T.span_hashes(h, w.first[few], w.first[few + 1], T._WORD_BASE) if len(few) else np.zeros(0, np.uint64)
        values, text = np.concatenate([long_hashes, short]), np.concatenate([w.text[at], few])
        # Sorted by text and then value: by value first, then stably by text.
        order = np.argsort(values)
        order = order[np.argsort(text[order], kind="stable")]
        values, text = values[order], text[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
        self.values, self.text = values[new], text[new]
        self.first = np.searchsorted(self.text, np.arange(len(offsets)))

    @classmethod
    def of(cls, values: np.ndarray, first: np.ndarray) -> Sets:
        """Sets whose distinct hashes are known, sorted within each."""
        s = object.__new__(cls)
        s.values, s.first = values, first
        s.text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        return s

    def sizes(self) -> np.ndarray:
        return np.diff(self.first)

    def sums(self, seed: int) -> np.ndarray:
        """A hash of each whole set."""
        out = np.zeros(len(self.first) - 1, np.uint64)
        np.add.at(out, self.text, T.mix(self.values ^ _U(seed)))
        return out


def _facts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, offsets, data in T.row_chunks(batch):
                s = Sets(offsets, data, size)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(i) for i in range(3)), pa.array(s.sizes(), pa.int64()),
                     pa.array(s.sums(0x1D8E4E27C47D124F).view(np.int64)), pa.array(s.sums(0x27220A95FE4BE3B5).view(np.int64))],
                    names=["doc_id", "row_key", "ord", "n", "s1", "s2"])
    return run


def size_classes(percent: int, most: int) -> np.ndarray:
    """Upper bounds of size classes: linked sets are of one class or of adjacent ones."""
    bounds = [1]
    while bounds[-1] < most:
        bounds.append(max(bounds[-1] + 1, bounds[-1] * 100 // percent))
    return np.array(bounds, np.int64)


def part_surplus(percent: int) -> float:
    """Parts for each element that may differ, so many that of randomly filled parts those with
    two or more elements outnumber the differences by 4 % (2 at most)."""
    for surplus in np.arange(1.05, 2, 0.05):
        mean = percent / (100 - percent) / surplus
        if surplus * (1 - math.exp(-mean) * (1 + mean)) >= 1.04:
            return float(surplus)
    return 2.0


def signatures(s: Sets, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, signature): two linked sets have at least one signature in common."""
    n = s.sizes()
    texts, out = [], []
    if not len(s.values):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    bounds = size_classes(percent, int(n.max()))
    own = np.searchsorted(bounds, n)
    surplus = part_surplus(percent)
    for down in (0, 1):
        c = own - down
        use = (n > 0) & (c >= 0)
        bound = np.where(use, bounds[np.maximum(c, 0)], 0)
        parts = np.where(use, (bound * (100 - percent) * surplus).astype(np.int64) // percent + 1, 0)
        # Elements in which the set may differ from a linked one of this class.
        differ = np.minimum(n, bound) * (100 - percent) // percent
        begin = np.concatenate([[0], np.cumsum(parts)])
        inside = use[s.text]
        text, values = s.text[inside], s.values[inside]
        of_part = np.repeat(np.arange(len(n)), parts)
        number = np.arange(begin[-1]) - begin[of_part]

        def divided(seed: int) -> tuple[np.ndarray, np.ndarray]:
            """Hash and size of each part in one division of the sets."""
            mixed = T.mix(values ^ _U(seed))
            at = begin[text] + (((mixed >> _U(32)) * parts[text].astype(np.uint64)) >> _U(32)).astype(np.int64)
            total = np.zeros(begin[-1], np.uint64)
            np.add.at(total, at, T.mix(mixed))
            held = np.bincount(at, minlength=begin[-1])
            place = T.mix((c[of_part].astype(np.uint64) << _U(32)) | number.astype(np.uint64)) ^ _U(seed)
            return T.mix(total ^ place ^ (held.astype(np.uint64) << _U(48))), held

        sig, held = divided(0x9FB21C651E98DF25)
        telling = held > 1
        # One part alone is the whole set.
        telling |= parts[of_part] == 1
        texts.append(of_part[telling])
        out.append(sig[telling])
        lacking = use & (np.bincount(of_part[telling], minlength=len(n)) <= differ)
        # The number of parts belongs to the class, so linked sets take the same of the two ways.
        weak = np.flatnonzero(~telling & (lacking & (parts <= FEW_PARTS))[of_part])
        if len(weak):
            other, _ = divided(0xD1B54A32D192ED03)
            k = parts[of_part[weak]]
            which = np.repeat(weak, k)
            j = begin[of_part[which]] + np.arange(len(which)) - np.repeat(np.cumsum(k) - k, k)
            texts.append(of_part[which])
            out.append(T.mix(sig[which] ^ (other[j] * _U(T._BYTE_BASE))))
        larger = np.flatnonzero((lacking & (parts > FEW_PARTS))[text])
        if len(larger):
            # A set's elements are sorted, so that its first are the least hashes.
            few = n - (percent * n + 99) // 100 + 1
            rank = np.flatnonzero(inside)[larger] - s.first[text[larger]]
            early = larger[rank < few[text[larger]]]
            texts.append(text[early])
            out.append(T.mix(values[early] ^ T.mix(c[text[early]].astype(np.uint64))))
    return np.concatenate(texts), np.concatenate(out)


def _distinct(pairs: np.ndarray) -> np.ndarray:
    """Distinct rows (a, b) with a <> b."""
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    new = np.ones(len(pairs), bool)
    new[1:] = (pairs[1:] != pairs[:-1]).any(1)
    return pairs[new]


def _stars(sig: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct signatures in their order, the least node of each, and the distinct pairs of
    that and another node of the signature."""
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    new = np.ones(len(sig), bool)
    new[1:] = sig[1:] != sig[:-1]
    least = node[new]
    pairs = np.column_stack([least[np.cumsum(new) - 1], node])[~new] if len(sig) else np.zeros((0, 2), np.int64)
    return sig[new], least, _distinct(pairs)


def _binaries(rows: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Bytes of the rows up to each end from the end before."""
    width = rows.dtype.itemsize * rows.shape[1]
    offsets = np.concatenate([[0], ends * width]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _packed(held: list[tuple[np.ndarray, np.ndarray]], bits: int) -> pa.RecordBatch:
    """A row for each of 2**bits shards: its signatures and their nodes, and some of the pairs."""
    sig, node, pairs = _stars(*(np.concatenate(x) for x in zip(*held)))
    shards = np.arange(1 << bits)
    ends = np.searchsorted((sig >> _U(LOW_BITS)) >> _U(64 - LOW_BITS - bits), shards.astype(np.uint64), "right")
    low = (sig >> _U(64 - LOW_BITS - bits)).view(np.uint8).reshape(-1, 8)[:, : LOW_BITS // 8]
    return pa.RecordBatch.from_arrays(
        [pa.array(shards, pa.int32()), _binaries(low, ends), _binaries(node[:, None], ends), _binaries(pairs, (shards + 1) * len(pairs) >> bits)],
        names=["shard", "sigs", "nodes", "pairs"])


def _signatures(size: int, percent: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for rows, offsets, data in T.row_chunks(batch):
                text, sig = signatures(Sets(offsets, data, size), percent)
                held.append((sig, rows.column(0).to_numpy()[text]))
                n += len(sig)
                if n >= PACKED:
                    yield _packed(held, bits)
                    held, n = [], 0
        if n:
            yield _packed(held, bits)
    return run


def _shared(group: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) that connect the nodes of each signature of a shard."""
    low = np.frombuffer(b"".join(group["sigs"]), np.uint8).reshape(-1, LOW_BITS // 8)
    sig = np.zeros((len(low), 8), np.uint8)
    sig[:, : LOW_BITS // 8] = low
    _, _, pairs = _stars(sig.view(np.uint64)[:, 0], np.frombuffer(b"".join(group["nodes"]), np.int64))
    sent = np.frombuffer(b"".join(group["pairs"]), np.int64).reshape(-1, 2)
    return pd.DataFrame(_distinct(np.concatenate([pairs, sent])), columns=["a", "b"])


def _set_signatures(percent: int):
    """Signatures of sets (region, node, told, shingles) in their region."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, offsets, data in T.row_chunks(batch, "shingles"):
                text, sig = signatures(Sets.of(np.frombuffer(data.tobytes(), np.uint64), offsets // 8), percent)
                region, node, told = (rows.column(i).take(pa.array(text, pa.int64())) for i in range(3))
                yield pa.RecordBatch.from_arrays([region, pa.array(sig.view(np.int64)), node, told], names=["region", "sig", "node", "told"])
    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, offsets, data in T.row_chunks(batch):
                s = Sets(offsets, data, size)
                packed = [s.values[a:b].tobytes() for a, b in zip(s.first[:-1].tolist(), s.first[1:].tolist())]
                keep = [i for i, c in enumerate(rows.schema.names) if c != "text"]
                yield pa.RecordBatch.from_arrays([*(rows.column(i) for i in keep), pa.array(packed, pa.binary())],
                                                 names=[*(rows.schema.names[i] for i in keep), "shingles"])
    return run


class Region:
    """Sets of one task over their common universe, to measure distances in bulk."""

    def __init__(self, packed: list[bytes]):
        self.sizes = np.array([len(p) // 8 for p in packed], np.int64)
        values = np.frombuffer(b"".join(packed), np.uint64)
        _, self.flat = np.unique(values, return_inverse=True)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        self.universe = int(self.flat.max()) + 1 if len(self.flat) else 0

    def shared(self, pivot: int, members: np.ndarray) -> np.ndarray:
        """Sizes of the intersections with the pivot."""
        mark = np.zeros(self.universe, np.int64)
        mark[self.flat[self.first[pivot]: self.first[pivot + 1]]] = 1
        if len(members) > len(self.sizes) // 2:
            return np.add.reduceat(mark[self.flat], self.first[:-1])[members]
        return np.array([mark[self.flat[self.first[m]: self.first[m + 1]]].sum() for m in members.tolist()], np.int64)

    def near(self, pivot: int, members: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """(linked, distance) of the members to the pivot; linked is exact."""
        both = self.shared(pivot, members)
        union = self.sizes[pivot] + self.sizes[members] - both
        return 100 * both >= percent * union, 1 - both / union


def region_links(packed: list[bytes], percent: int, first_block: int | None = None, told: int = 0) -> list[tuple[int, int]]:
    """Links that connect what the links of these sets connect. With first_block, only pairs of
    one of the first so many sets with one of the others are looked at; the last ``told`` sets aren't
    compared with each other."""
    region = Region(packed)
    n = len(packed)
    label = np.arange(n)
    open_ = np.ones(n, bool)
    r = 1 - percent / 100 + 1e-9
    windows: list[np.ndarray] = []  # distances to the first few pivots; NaN: not measured
    links = []
    for p in range(n - told if first_block is None else first_block):
        open_[p] = False
        others = open_ & (label != label[p]) & (np.minimum(region.sizes, region.sizes[p]) * 100 >= percent * np.maximum(region.sizes, region.sizes[p]))
        if first_block is not None:
            others[:first_block] = False
        for d in windows:
            others &= ~(np.abs(d - d[p]) > r)
        members = np.flatnonzero(others)
        if not len(members):
            continue
        linked, distance = region.near(p, members, percent)
        for m in members[linked].tolist():
            links.append((p, m))
            if label[m] != label[p]:
                label[label == label[m]] = label[p]
        if len(windows) < 8:
            d = np.full(n, np.nan)
            d[members], d[p] = distance, 0.0
            windows.append(d)
    return links


def _leaves(percent: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, g in group.groupby("region", sort=False):
            nodes = g["node"].to_numpy()
            told = g["told"].to_numpy(bool) if "told" in g else np.zeros(len(g), bool)
            order = np.lexsort((nodes, told))
            packed = g["shingles"].to_numpy()[order]
            out += [(nodes[order[a]], nodes[order[b]]) for a, b in region_links(list(packed), percent, told=int(told.sum()))]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")
    return run


def _blocks(percent: int):
    """One pair of blocks of a region: rows with side 0 and with side 1 (none: one block alone)."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        alone = group["i"].iat[0] == group["j"].iat[0]
        group = group.sort_values(["side", "node"])
        nodes, first = group["node"].to_numpy(), int((group["side"] == 0).sum())
        links = region_links(list(group["shingles"]), percent, None if alone else first)
        return pd.DataFrame([(nodes[a], nodes[b]) for a, b in links], columns=["a", "b"], dtype="int64")
    return run


def _to_pivots(percent: int):
    """Links of members to their region's pivots, and the Voronoi cells that they go to."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        r = 1 - percent / 100 + 1e-9
        pivots = group[group["pivot"] >= 0].sort_values("pivot")
        members = group[group["pivot"] < 0]
        region = Region([*pivots["shingles"], *members["shingles"]])
        k = len(pivots)
        at = np.arange(k, k + len(members))
        linked, distance = (np.column_stack(x) for x in zip(*(region.near(p, at, percent) for p in range(k))))
        nearest = distance.min(1)
        cells = (distance <= nearest[:, None] + 2 * r) & (distance < FAR + r)
        names = pivots["node"].to_numpy()
        numbers = np.arange(k)
        out = pd.DataFrame({
            "region": members["region"].to_numpy(), "node": members["node"].to_numpy(),
            "linked": [names[x].tolist() for x in linked],
            "cells": [[*numbers[c].tolist(), *([k] if far else [])] for c, far in zip(cells, nearest >= FAR - r)]})
        if group["salt"].iat[0] == 0:
            # The pivots among themselves, once; they go to no cell.
            to_each = np.column_stack([region.near(p, numbers, percent)[0] for p in range(k)])
            out = pd.concat([out, pd.DataFrame({"region": pivots["region"].to_numpy(), "node": names,
                                                "linked": [names[x].tolist() for x in to_each], "cells": [[] for _ in range(k)]})])
        return out
    return run


def _labels(group: pd.DataFrame) -> pd.DataFrame:
    """Components of a region's pivots: rows (region, a, b) of pivots with a common member."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in zip(group["a"].tolist(), group["b"].tolist()):
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return pd.DataFrame({"region": group["region"].iat[0], "pivot": list(parent), "label": [root(x) for x in list(parent)]})


def _round(members: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One round of pivots over regions (region, node, told): the links found, the next
    regions, and those that pivots can't divide. told: whether the member belongs to the main
    component of its region, whose members needn't be compared with each other."""
    sizes = written(members.groupBy("region").agg(F.ceil(F.count(F.lit(1)) / TOGETHER).cast("int").alias("salts")), "sizes")
    # Members that belong nowhere yet are pivots first; PIVOTS least by hash of each region.
    rank = F.struct("told", F.xxhash64("node", "region").alias("x"), "node")
    best = _least(members.withColumn("rank", rank), "rank", PIVOTS)
    pivots = written(best.select("region", F.posexplode("best").alias("pivot", "p")).select("region", "pivot", F.col("p.node").alias("node")), "pivots")
    rest = members.join(pivots.select("region", "node"), ["region", "node"], "left_anti")
    dealt = (rest.join(sizes, "region").select("region", "node", F.lit(-1).alias("pivot"), F.pmod(F.xxhash64("node"), "salts").cast("int").alias("salt"))
             .unionByName(pivots.join(sizes, "region").select(
                 "region", "node", "pivot", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))))
    to_pivots = _to_pivots(percent)
    seen = written(dealt.join(sets, "node").groupBy("region", "salt").applyInPandas(
        lambda g: to_pivots(g), "region bigint, node bigint, linked array<bigint>, cells array<int>"), "distances")
    links = seen.select(F.explode("linked").alias("a"), F.col("node").alias("b"))
    first = F.get("linked", F.lit(0))
    pairs = seen.where("size(linked) > 0").select("region", first.alias("a"), F.explode("linked").alias("b")).distinct()
    # PIVOTS ** 2 rows of a region at most.
    labels = written(pairs.groupBy("region").applyInPandas(_labels, "region bigint, pivot bigint, label bigint"), "labels")
    told = written(seen.select("region", "node", "cells", first.alias("pivot"))
                   .join(labels, ["region", "pivot"], "left").select("region", "node", "label", "cells"), "labelled")
    # The largest component of a region is its main one; who is in it needs only be compared with others.
    main = (told.where("label is not null").groupBy("region", "label").count()
            .groupBy("region").agg(F.max_by("label", "count").alias("main")))
    told = (told.where("size(cells) > 0").join(written(main, "main"), "region", "left")
            .select("region", "node", "cells", F.coalesce(F.col("label") == F.col("main"), F.lit(False)).alias("told")))
    in_cells = written(told.select("region", "node", "told", F.explode("cells").alias("c"))
                       .select("region", F.xxhash64("region", "c").alias("cell"), "node", "told"), "cells")
    # A cell whose members all belong to the main component is done.
    open_cells = written(in_cells.groupBy("region", "cell").agg(F.count(F.lit(1)).alias("n"), F.min("told").alias("done"))
                         .where("n > 1 and not done").select("region", "cell", "n"), "open-cells")
    # Where windows copy members into so many cells that cells don't make a region smaller, it
    # is joined as it is, by blocks.
    flat = written(open_cells.groupBy("region").agg(F.sum("n").alias("n"), F.max("n").alias("largest"))
                   .join(told.groupBy("region").agg(F.count(F.lit(1)).alias("whole")), "region")
                   .where("n > 1.5 * whole or largest > 0.8 * whole").select("region"), "flat-regions")
    nexts = (in_cells.join(open_cells.join(flat, "region", "left_anti").select("cell"), "cell")
             .select(F.col("cell").alias("region"), "node", "told"))
    rest = told.join(flat, "region").select("region", "node", "told")
    return links, nexts, rest


def _least(rows: DataFrame, column: str, k: int) -> DataFrame:
    """The k least values of the column in each region (region, best), by blocks first."""
    blocks = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.lit(256)))
    few = blocks.withColumn("i", F.row_number().over(Window.partitionBy("region", "block").orderBy(column))).where(F.col("i") <= k)
    return few.groupBy("region").agg(F.slice(F.array_sort(F.collect_list(column)), 1, k).alias("best"))


def links(docs: DataFrame, percent: int, size: int, elements: int) -> DataFrame:
    """(a, b) of class nodes: links that connect what all links connect. docs (doc_id,
    text): one row for each distinct set; nodes are row keys. elements: about as many as the
    sets have together, for the number of shards."""
    texts = docs.select(row_key().alias("row_key"), F.col("text").cast("string").alias("text"))
    bits = min(64 - LOW_BITS, (elements // PACKED).bit_length())
    pairs = (texts.mapInArrow(_signatures(size, percent, bits), "shard int, sigs binary, nodes binary, pairs binary")
             .groupBy("shard").applyInPandas(_shared, "a bigint, b bigint"))
    coarse = written(components(pairs), "regions").withColumnRenamed("component", "region")
    sizes = written(coarse.groupBy("region").agg(F.count(F.lit(1)).alias("n")), "region-sizes")
    small = coarse.join(sizes.where(F.col("n") <= LEAF), "region").select("region", "node")
    large = coarse.join(sizes.where(F.col("n") > LEAF), "region").select("region", "node", F.lit(False).alias("told"))

    def sets_of(nodes: DataFrame) -> DataFrame:
        typed = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema if f.name != "node")
        wanted = nodes.withColumnRenamed("node", "row_key")
        got = with_texts(docs, wanted, ["text"]).dropDuplicates(["row_key"])
        return (got.select("row_key", *(c for c in wanted.columns if c != "row_key"), F.col("text").cast("string").alias("text"))
                .mapInArrow(_sets(size), f"node bigint{', ' + typed if typed else ''}, shingles binary"))

    leaf = _leaves(percent)
    bins = max(1, -(-small.count() // TOGETHER))
    out = [written(sets_of(written(small, "small-regions")).withColumn("bin", F.pmod(F.xxhash64("region"), F.lit(bins)))
                   .groupBy("bin").applyInPandas(lambda g: leaf(g), "a bigint, b bigint"), "links")]
    if not large.isEmpty():
        members = written(large, "large-regions")
        sets = written(sets_of(members.select("node")), "sets")
        for _ in range(ROUNDS):
            found, following, undivided = _round(members, sets, percent)
            out.append(written(found, "links"))
            undivided = written(undivided, "undivided")
            if not undivided.isEmpty():
                out.append(written(_undivided(undivided, sets, percent), "links"))
            members = written(following, "next-regions")
            if members.isEmpty():
                break
            counts = written(members.groupBy("region").agg(F.count(F.lit(1)).alias("n")), "region-sizes")
            done = members.join(counts.where(F.col("n") <= LEAF), "region")
            bins = max(1, -(-(counts.where(F.col("n") <= LEAF).agg(F.sum("n")).first()[0] or 0) // TOGETHER))
            out.append(written(done.join(sets, "node").withColumn("bin", F.pmod(F.xxhash64("region"), F.lit(bins)))
                               .groupBy("bin").applyInPandas(lambda g: leaf(g), "a bigint, b bigint"), "links"))
            members = written(members.join(counts.where(F.col("n") > LEAF), "region").drop("n"), "large-regions")
            if members.isEmpty():
                break
        else:
            out.append(written(_undivided(members, sets, percent), "links"))
    every = out[0]
    for o in out[1:]:
        every = every.unionByName(o)
    return every


def _undivided(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of regions (region, node, told) that cells don't divide: by the members that share a
    signature, or by pairs of blocks where that sends fewer sets."""
    parts = written(members.join(sets, "node").select("region", "node", "told", "shingles")
                    .mapInArrow(_set_signatures(percent), "region bigint, sig bigint, node bigint, told boolean"), "region-parts")
    open_ = F.sum(F.when(F.col("told"), 0).otherwise(1))
    sharing = parts.groupBy("region", "sig").agg(
        F.count(F.lit(1)).alias("n"), open_.alias("others"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    # Of signatures that the same members share, one counts.
    groups = written(sharing.where("n > 1 and others > 0").groupBy("region", "n", "others", "x", "y").agg(F.min("sig").alias("sig")), "sharing")
    sent = F.col("n") * F.when(F.col("n") <= LEAF, 1).otherwise(F.ceil(F.col("others") / LEAF))
    by_blocks = members.groupBy("region").agg((F.count(F.lit(1)) * F.ceil(open_ / LEAF)).alias("blocks"))
    divided = written(by_blocks.join(groups.groupBy("region").agg(F.sum(sent).alias("sent")), "region", "left")
                      .where("coalesce(sent, 0) <= blocks").select("region"), "divided-regions")
    groups = written(groups.join(divided, "region", "left_semi").select("region", "sig", "n"), "sharing")
    may_hold = id_filter(groups, "region", "sig")
    dealt = written(parts.where(may_hold(F.col("region"), F.col("sig"))).join(groups, ["region", "sig"])
                    .select(F.xxhash64("region", "sig").alias("region"), "node", "told", "n"), "shared-by")
    small = dealt.where(F.col("n") <= LEAF)
    bins = max(1, -(-small.count() // TOGETHER))
    leaf = _leaves(percent)
    found = (small.join(sets, "node").withColumn("bin", F.pmod(F.xxhash64("region"), F.lit(bins)))
             .groupBy("bin").applyInPandas(lambda g: leaf(g), "a bigint, b bigint"))
    large = written(dealt.where(F.col("n") > LEAF).select("region", "node", "told")
                    .unionByName(members.join(divided, "region", "left_anti").select("region", "node", "told")), "undivided")
    return found if large.isEmpty() else found.unionByName(_by_blocks(large, sets, percent))


def _by_blocks(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Exact join of regions (region, node, told) by pairs of blocks of about LEAF members:
    blocks of members outside the main component with each other and with blocks of it."""
    sizes = written(members.groupBy("region").agg(
        F.ceil(F.count(F.lit(1)) / LEAF).cast("int").alias("all"),
        F.ceil(F.sum(F.when(F.col("told"), 0).otherwise(1)) / LEAF).cast("int").alias("others")), "blocks")
    # The others fill the blocks from 0 on, the main component those after them.
    placed = (members.join(sizes, "region")
              .withColumn("block", F.when(F.col("told"), F.col("others") + F.pmod(F.xxhash64("node"), "all"))
                          .otherwise(F.pmod(F.xxhash64("node"), F.greatest("others", F.lit(1)))).cast("int"))
              .where("others > 0"))
    last = F.col("others") + F.col("all") - 1
    as_first = placed.where(~F.col("told")).select(
        "region", "node", F.lit(0).alias("side"), F.col("block").alias("i"), F.explode(F.sequence("block", last)).alias("j"))
    as_second = placed.select(
        "region", "node", F.lit(1).alias("side"),
        F.explode(F.sequence(F.lit(0), F.least("block", F.col("others") - 1))).alias("i"), F.col("block").alias("j")).where("i <> j")
    block_pair = _blocks(percent)
    return (as_first.unionByName(as_second).join(sets, "node").groupBy("region", "i", "j")
            .applyInPandas(lambda g: block_pair(g), "a bigint, b bigint"))


def join(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """One row per document row: doc_id, row_key, n_shingles, component_id (the least doc_id
    that links lead to, its own included), keeper (whether it is the one document of its
    component to keep: the row of the least doc_id)."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    facts = written(docs.select("doc_id", row_key().alias("row_key"), document_order().alias("ord"), "text")
                    .mapInArrow(_facts(size), f"doc_id {id_type}, row_key bigint, ord bigint, n bigint, s1 bigint, s2 bigint"), "facts")
    kind = ["n", "s1", "s2"]
    first = F.min(F.struct("ord", "row_key"))
    classes = written(facts.where("n > 0").groupBy(*kind).agg(first.alias("first"), F.count(F.lit(1)).alias("copies")), "classes")
    others = (facts.join(classes.where("copies > 1").select(*kind, "first"), kind)
              .where(F.col("row_key") != F.col("first.row_key")).select("row_key"))
    empty = facts.where("n = 0").select("row_key")
    elements = facts.agg(F.sum("n")).first()[0] or 0
    found = links(drop_rows(docs, written(others.unionByName(empty), "other-copies")), percent, size, elements)
    parts = written(components(found), "components")
    joined = classes.select(*kind, "first").join(parts.select(F.col("node").alias("key"), "component"), F.col("first.row_key") == F.col("key"), "left")
    whole = written(joined.select(*kind, "first", F.coalesce("component", F.col("first.row_key")).alias("component")), "class-components")
    least = written(whole.groupBy("component").agg(F.min("first").alias("least")), "least")
    by_class = written(whole.join(least, "component").select(*kind, "least"), "class-ids")

    def number(order: Column) -> Column:
        return F.when(order == (1 << 63) - 1, F.lit(None)).otherwise(order).cast(id_type)

    return (facts.where("n > 0").join(by_class, kind)
            .select("doc_id", "row_key", F.col("n").alias("n_shingles"), number(F.col("least.ord")).alias("component_id"),
                    (F.col("row_key") == F.col("least.row_key")).alias("keeper"))
            .unionByName(facts.where("n = 0").select("doc_id", "row_key", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                                                     F.lit(True).alias("keeper"))))
