"""Interpolated Kneser-Ney character models, counted and joined on Spark.

A model has one set of 4-gram tables for each group (a language). Tasks count packed
4-grams of their texts; the summed counts are sharded by gram, and joins of counts with
context totals and with the next lower order give every gram's interpolated probability
and every context's backoff weight. Lower orders use continuation counts: how many
different characters precede a gram. Discounts come from counts of counts: one for
each order, or three for each order in the modified form.

The tables keep every gram's whole 64-bit key and stay Spark tables: they grow with the
text that was counted, and neither the driver nor a task ever holds a model. For scoring,
the most frequent grams and their values go to all tasks as sorted arrays of at most
``HEAD_BYTES``. A task adds up what its texts have there and hands over the other grams
with how often they occur in a text; only these are joined with the tables, and what they
add is summed for each text. No text is stored or shuffled. Values are whole multiples of
2**-24, so that sums don't depend on their order.

Characters are UTF-16 code units: one beyond 16 bits is two of them, and none is taken for
another. A text is held once as units and once as grams, whatever its length.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.llm import text as T
from rateflow.llm.common import written

ORDER = 4
BLANK = 32
# A task hands its counts over when it holds so many different grams.
HELD_GRAMS = 2_000_000
# What the sorted arrays of frequent grams may take in a task.
HEAD_BYTES = 16 << 20
# Values are kept as multiples of 1 / UNIT.
UNIT = 1 << 24


@cache
def fold_table(letters_only: bool) -> np.ndarray:
    """What each 16-bit code counts as: lower-cased letters and marks with the rest blank,
    or every character as it is with white space blank."""
    out = np.arange(1 << 16, dtype=np.uint16)
    for c in range(1 << 16):
        ch = chr(c)
        if not letters_only:
            if ch.isspace():
                out[c] = BLANK
        elif ch.isalpha() or unicodedata.category(ch)[0] == "M":
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else c
        else:
            out[c] = BLANK
    return out


@cache
def _alpha() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(1 << 16)])


class Grams:
    """Packed 4-grams of a few texts: one for each kept character, with the three before it
    (blanks before the first). Runs of blanks count as one."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, letters_only: bool):
        n = len(offsets) - 1
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]  # in characters
        if len(points) != at[-1]:  # malformed input: take each text alone
            parts = [np.frombuffer(data[a:b].tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
                     for a, b in zip(offsets, offsets[1:])]
            at = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            points = np.concatenate(parts) if parts else points
        wide = points >= 1 << 16
        if wide.any():
            points, at, has, codes = self._units(points, at, wide, letters_only)
        else:
            codes = points.astype(np.uint16)
            has = _alpha()[codes]
        codes_folded = np.where(codes >> 11 == 0x1B, codes, fold_table(letters_only)[codes])
        keep = np.ones(len(points), bool)
        keep[1:] = (codes_folded[1:] != BLANK) | (codes_folded[:-1] != BLANK)
        keep[at[:-1][at[:-1] < len(points)]] = True
        kept_before = np.concatenate([[0], np.cumsum(keep)])
        seen = np.concatenate([[0], np.cumsum(has)])
        self.first = kept_before[at]  # of each text, in kept characters
        self.has_letter = (seen[at[1:]] - seen[at[:-1]]) > 0
        kept = codes_folded[keep].astype(np.uint64)
        m = len(kept)
        # Three blanks before each text keep its grams apart from the text before.
        pads = np.repeat(np.arange(1, n + 1) * (ORDER - 1), np.diff(self.first))
        padded = np.full(m + n * (ORDER - 1), BLANK, np.uint64)
        place = np.arange(m) + pads
        padded[place] = kept
        grams = padded.copy()
        for back in range(1, ORDER):
            grams[back:] |= padded[:-back] << np.uint64(16 * back)
        self.grams = grams[place]

    @staticmethod
    def _units(points: np.ndarray, at: np.ndarray, wide: np.ndarray, letters_only: bool):
        """Code points as UTF-16 units, where each text begins in them, which units are of
        letters, and the units with what doesn't count as a letter or mark beyond 16 bits blank."""
        place = np.concatenate([[0], np.cumsum(1 + wide)])
        units = np.zeros(place[-1], np.uint32)
        units[place[:-1]] = np.where(wide, 0xD800 + ((points - 0x10000) >> 10), points)
        units[place[:-1][wide] + 1] = 0xDC00 + (points[wide] & 0x3FF)
        has = _alpha()[units.astype(np.uint16)]
        of_wide = np.flatnonzero(wide)
        letter = np.array([chr(p).isalpha() for p in points[of_wide].tolist()])
        for k in (0, 1):
            has[place[of_wide] + k] = letter
        if letters_only:
            mark = np.array([unicodedata.category(chr(p))[0] == "M" for p in points[of_wide].tolist()])
            for k in (0, 1):
                units[place[of_wide[~letter & ~mark]] + k] = BLANK
        return units, place[at], has, units.astype(np.uint16)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def of(self, texts: np.ndarray) -> Grams:
        """Only these texts (ascending numbers)."""
        part = object.__new__(Grams)
        wanted = np.zeros(len(self.first) - 1, bool)
        wanted[texts] = True
        part.grams = self.grams[np.repeat(wanted, self.counts())]
        part.first = np.concatenate([[0], np.cumsum(self.counts()[texts])])
        part.has_letter = self.has_letter[texts]
        return part


def _count(letters_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def merged(parts):
            keys = np.concatenate([k for k, _ in parts])
            order = np.argsort(keys)
            keys = keys[order]
            n = np.concatenate([c for _, c in parts])[order]
            heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            return keys[heads], np.add.reduceat(n, heads)

        def handed_over():
            for group, parts in held.items():
                keys, n = merged(parts)
                for i in range(0, len(keys), 100_000):
                    k = keys[i: i + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([group] * len(k), pa.string()), pa.array(k.view(np.int64)), pa.array(n[i: i + 100_000])],
                        names=["grp", "gram", "n"])
            held.clear()

        for batch in batches:
            for rows, offsets, data in T.row_chunks(batch):
                g = Grams(offsets, data, letters_only)
                groups = np.array(rows.column(0).to_pylist(), object)
                of_char = np.repeat(np.arange(len(groups)), g.counts())
                for group in set(groups.tolist()):
                    mine = g.grams[(groups == group)[of_char]]
                    if len(mine):
                        held.setdefault(group, []).append(np.unique(mine, return_counts=True))
                        size += len(held[group][-1][0])
            if size > HELD_GRAMS:
                held = {group: [merged(parts)] for group, parts in held.items()}
                size = sum(len(parts[0][0]) for parts in held.values())
                if size > HELD_GRAMS // 2:
                    yield from handed_over()
                    size = 0
        yield from handed_over()
    return run


def count_grams(texts: DataFrame, letters_only: bool) -> DataFrame:
    """(grp, gram, n) over all rows of texts (grp, text); rows with null grp don't count."""
    return (texts.where("grp is not null").select("grp", F.col("text").cast("string").alias("text"))
            .mapInArrow(_count(letters_only), "grp string, gram bigint, n bigint")
            .groupBy("grp", "gram").agg(F.sum("n").alias("n")))


def _discounts(counts: DataFrame, modified: bool) -> DataFrame:
    """(grp, d1, d2, d3) from how many grams have each small count."""
    few = counts.groupBy("grp").agg(*(F.greatest(F.lit(1), F.sum((F.col("n") == k).cast("long"))).alias(f"n{k}") for k in (1, 2, 3, 4)))
    n1, n2, n3, n4 = (F.col(f"n{k}") for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3) if modified else (y, y, y)
    return few.select("grp", *(F.least(F.greatest(x, F.lit(0.05)), F.lit(k)).alias(f"d{i}") for i, (x, k) in enumerate(zip(d, (0.95, 1.9, 2.9)), 1)))


def train(counts: DataFrame, modified: bool) -> Model:
    """Model of the summed 4-gram counts (grp, gram, n)."""
    by_order = {ORDER: written(counts, "grams")}
    for order in range(ORDER - 1, 0, -1):
        mask = (1 << (16 * order)) - 1
        by_order[order] = written(
            by_order[order + 1].groupBy("grp", F.col("gram").bitwiseAND(F.lit(mask)).alias("gram"))
            .agg(F.count(F.lit(1)).alias("n")), "grams")
    probabilities: dict[int, DataFrame] = {}
    weights: dict[int, DataFrame] = {}
    unknown = lower = None
    for order in range(1, ORDER + 1):
        c = by_order[order]
        d = F.broadcast(written(_discounts(c, modified), "discounts"))
        n, take = F.col("n"), F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        c = c.join(d, "grp").select("grp", "gram", n, F.least(take, n.cast("double")).alias("cut"),
                                    F.shiftrightunsigned("gram", 16).alias("ctx"))
        context = written(c.groupBy("grp", "ctx").agg(
            F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("weight"), F.count(F.lit(1)).alias("types")), "contexts")
        c = c.join(context, ["grp", "ctx"])
        own = (F.col("n") - F.col("cut")) / F.col("total")
        if order == 1:
            # The lowest order is mixed with even odds over the characters met and one more.
            p = c.select("grp", "gram", (own + F.col("weight") / (F.col("types") + 1)).alias("p"))
            unknown = context.select("grp", F.log(F.col("weight") / (F.col("types") + 1)).alias("value"))
        else:
            mask = (1 << (16 * (order - 1))) - 1
            below = lower.select("grp", F.col("gram").alias("suffix"), F.col("p").alias("below"))
            p = (c.withColumn("suffix", F.col("gram").bitwiseAND(F.lit(mask))).join(below, ["grp", "suffix"])
                 .select("grp", "gram", (own + F.col("weight") * F.col("below")).alias("p")))
            weights[order] = context.select("grp", "ctx", F.log("weight").alias("weight"))
        lower = written(p, "probabilities")
        probabilities[order] = lower.select("grp", "gram", F.log("p").alias("value"))
    return Model(by_order[ORDER], probabilities, weights, unknown)


class Model:
    """Tables of all groups: counts (grp, gram, n), log probabilities (grp, gram, value) of each order, the log backoff
    weights (grp, ctx, weight) of the contexts of orders 2 to 4, and the log probability of an
    unknown character (grp, value), one row for each group."""

    def __init__(self, counts: DataFrame, probabilities: dict[int, DataFrame], weights: dict[int, DataFrame], unknown: DataFrame):
        self.counts, self.probabilities, self.weights, self.unknown = counts, probabilities, weights, unknown

    def groups(self) -> DataFrame:
        return self.unknown.select("grp")

    def look_up(self, needed: DataFrame, order: int = ORDER) -> DataFrame:
        """(grp, gram, value): log P(last character | the ones before) of distinct (grp, gram),
        for groups of the model."""
        shown = written(needed.join(self.probabilities[order], ["grp", "gram"], "left"), "looked-up")
        found, missed = shown.where("value is not null"), shown.where("value is null").select("grp", "gram")
        if missed.isEmpty():
            return found
        if order == 1:
            return found.unionByName(missed.join(self.unknown, "grp"))
        mask = (1 << (16 * (order - 1))) - 1
        missed = missed.select("grp", "gram", F.col("gram").bitwiseAND(F.lit(mask)).alias("suffix"), F.shiftrightunsigned("gram", 16).alias("ctx"))
        lower = self.look_up(missed.select("grp", F.col("suffix").alias("gram")).distinct(), order - 1)
        backed_off = (missed.join(lower.select("grp", F.col("gram").alias("suffix"), F.col("value").alias("below")), ["grp", "suffix"])
                      .join(self.weights[order], ["grp", "ctx"], "left")
                      .select("grp", "gram", (F.coalesce("weight", F.lit(0.0)) + F.col("below")).alias("value")))
        return found.unionByName(backed_off)

    def log_p(self, group: str, grams: np.ndarray) -> np.ndarray:
        """log P(last character | the three before) of a few packed grams."""
        keys, inverse = np.unique(grams.astype(np.uint64), return_inverse=True)
        needed = self.unknown.sparkSession.createDataFrame([(group, g) for g in keys.view(np.int64).tolist()], "grp string, gram bigint")
        values = {r["gram"]: r["value"] for r in self.look_up(needed).collect()}
        return np.array([values[g] for g in keys.view(np.int64).tolist()])[inverse]


class EachGroup:
    """Scores under every group of a model, in the order of ``names``; texts have the grp ''."""

    def __init__(self, model: Model, names: list[str]):
        self.model, self.names, self.width = model, names, len(names)

    def counts(self) -> DataFrame:
        return self.model.counts.groupBy("gram").agg(F.sum("n").alias("n")).select(F.lit("").alias("grp"), "gram", "n")

    def values(self, needed: DataFrame) -> DataFrame:
        """(grp, gram, pos, value) of distinct (grp, gram)."""
        names = F.array(*(F.lit(n) for n in self.names))
        found = self.model.look_up(needed.select(F.explode(names).alias("grp"), "gram"))
        return found.select(F.lit("").alias("grp"), "gram", (F.array_position(names, F.col("grp")) - 1).cast("int").alias("pos"), "value")


class Mixed:
    """Scores under two models: that of the text's group mixed with its base, and its base
    alone. ``shares`` has (grp, base, share), the share of the group's own model."""

    width = 2

    def __init__(self, model: Model, shares: DataFrame):
        self.model, self.shares = model, shares

    def counts(self) -> DataFrame:
        return self.model.counts

    def values(self, needed: DataFrame) -> DataFrame:
        pairs = written(needed.join(self.shares, "grp"), "pairs")
        both = pairs.select("grp", "gram").unionByName(pairs.select(F.col("base").alias("grp"), "gram")).distinct()
        found = written(self.model.look_up(both), "found")
        base = found.select(F.col("grp").alias("base"), "gram", F.col("value").alias("below"))
        mixed = F.log(F.col("share") * F.exp("value") + (1 - F.col("share")) * F.exp("below"))
        return (pairs.join(found, ["grp", "gram"]).join(base, ["base", "gram"])
                .select("grp", "gram", F.posexplode(F.array(mixed, F.col("below"))).alias("pos", "value")))


def _in_units(values: DataFrame) -> DataFrame:
    return values.withColumn("value", F.round(F.col("value") * UNIT).cast("bigint"))


def _array_by_pos(column: str):
    return F.transform(F.array_sort(F.collect_list(F.struct("pos", column))), lambda x: x[column])


def _head(scorer) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """For each grp, the sorted grams that occur most and their values (a row for each gram);
    HEAD_BYTES in all."""
    level = F.floor(F.log2("n") * 4).cast("int").alias("level")
    room, least = HEAD_BYTES // (8 + 8 * scorer.width), None
    counts = scorer.counts().select("grp", "gram", level)
    for r in sorted(counts.groupBy("level").count().collect(), key=lambda r: -r["level"]):
        room -= r["count"]
        if room < 0:
            break
        least = r["level"]
    if least is None:
        return {}
    chosen = written(counts.where(F.col("level") >= least).select("grp", "gram"), "head")
    found = _in_units(scorer.values(chosen)).groupBy("grp", "gram").agg(_array_by_pos("value").alias("values")).toArrow()
    grams = found.column("gram").to_numpy().view(np.uint64)
    values = found.column("values").combine_chunks().flatten().to_numpy().reshape(-1, scorer.width)
    names = found.column("grp").combine_chunks().dictionary_encode()
    number = names.indices.to_numpy()
    out = {}
    for i, name in enumerate(names.dictionary.to_pylist()):
        mine = np.flatnonzero(number == i)
        mine = mine[np.argsort(grams[mine])]
        out[name] = grams[mine], values[mine]
    return out


def _partial(letters_only: bool, width: int, head):
    """Rows (grp, row, text) with what the head gives for their grams, and the other grams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        nothing = np.zeros(0, np.uint64), np.zeros((0, width), np.int64)
        for batch in batches:
            for rows, offsets, data in T.row_chunks(batch):
                every = Grams(offsets, data, letters_only)
                groups = np.array(rows.column(0).to_pylist(), object)
                for group in sorted(set(groups.tolist()), key=str):
                    mine = np.flatnonzero(groups == group)
                    g = every if len(mine) == len(groups) else every.of(mine)
                    keys, values = head.value.get(group, nothing)
                    sums, (first, grams, times) = _sums(g, keys, values, width)
                    m = len(mine)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.arange(number, number + m)), pa.array([group] * m, pa.string()), rows.column(1).take(pa.array(mine)),
                         pa.array(g.counts(), pa.int64()), pa.array(g.has_letter),
                         pa.ListArray.from_arrays(pa.array(np.arange(m + 1) * width, pa.int32()), pa.array(sums.ravel())),
                         pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(grams.view(np.int64))),
                         pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(times, pa.int64()))],
                        names=["number", "grp", "row", "n", "has_letter", "sums", "grams", "times"])
                    number += m
    return run


def _sums(g: Grams, keys: np.ndarray, values: np.ndarray, width: int):
    """For each text, the sums of its grams' values; and the grams that aren't among the keys:
    where each text's begin, the grams, how often each occurs in its text."""
    n = len(g.first) - 1
    sums = np.zeros((n, width), np.int64)
    full = np.flatnonzero(g.counts() > 0)
    if len(keys) and len(full):
        at = np.minimum(np.searchsorted(keys, g.grams), len(keys) - 1)
        known = keys[at] == g.grams
        for j in range(width):
            sums[full, j] = np.add.reduceat(np.where(known, values[at, j], 0), g.first[:-1][full])
        other = np.flatnonzero(~known)
    else:
        other = np.arange(len(g.grams))
    grams = g.grams[other]
    text = np.searchsorted(g.first, other, "right") - 1
    order = np.lexsort((grams, text))
    grams, text = grams[order], text[order]
    heads = np.flatnonzero(np.concatenate([[True], (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])])) if len(grams) else np.zeros(0, np.int64)
    times = np.diff(np.concatenate([heads, [len(grams)]]))
    return sums, (np.searchsorted(text[heads], np.arange(n + 1)), grams[heads], times)


def score(docs: DataFrame, scorer, letters_only: bool) -> DataFrame:
    """All rows of docs (grp, row, text) as (row, n, has_letter, sums): the characters of the text
    that count, whether it has a letter, and its log probability under each of the scorer's
    models. grp is never null."""
    spark = docs.sparkSession
    head = spark.sparkContext.broadcast(_head(scorer))
    row = docs.schema["row"].dataType.simpleString()
    marked = written(docs.select("grp", "row", "text").mapInArrow(
        _partial(letters_only, scorer.width, head),
        f"number bigint, grp string, row {row}, n bigint, has_letter boolean, sums array<bigint>, grams array<bigint>, times array<bigint>"), "marked")
    rest = marked.where(F.size("grams") > 0).select("number", "grp", F.inline(F.arrays_zip(F.col("grams").alias("gram"), "times")).alias("gram", "times"))
    needed = written(rest.select("grp", "gram").distinct(), "needed")
    more = (rest.join(_in_units(scorer.values(needed)), ["grp", "gram"])
            .groupBy("number", "pos").agg(F.sum(F.col("value") * F.col("times")).alias("value"))
            .groupBy("number").agg(_array_by_pos("value").alias("more")))
    total = F.when(F.col("more").isNull(), F.col("sums")).otherwise(F.zip_with("sums", "more", lambda a, b: a + b))
    return (marked.select("number", "row", "n", "has_letter", "sums").join(more, "number", "left")
            .select("row", "n", "has_letter", F.transform(total, lambda v: v / F.lit(float(UNIT))).alias("sums")))
