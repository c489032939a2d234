"""Prefix trie of conversations from adaptive radix trees.

A turn is its (role, text), known by a 128-bit id; a conversation is a byte key, the big-endian
ids of its turns one after the other. Equal conversations are one class of keys. Classes are
range-partitioned and sorted by key on Spark, and each task puts one run of keys after the other
(about RUN_BYTES of them) into an adaptive radix tree (``radix``). Bytes inside a turn's id are no
nodes of the trie: only depths that are multiples of the id's width emit one, be it at an
inner node or within a compressed path.

A run's nodes that don't lie on the path of its first or its last key are complete: no other run
has keys below them. Those paths' nodes are merged over all runs by the hash of their prefix.
A node of one run only is complete too; nodes of several runs add up their members and the
subtrees of their children that are complete, and sum what is below them by pointer jumping along
the parents, in as many rounds as the logarithm of their depth. So no task and no group
holds more than a run, the nodes of a hot first turn are spread over its runs, and a group of
equal conversations is one key.

The list of the ids that end at a node is hashed as a stream: ids are joined by ranges of 4096
values first, and the pieces of a class, sorted by Spark, go through one hash state.

Defined cases: null role and text are empty; null turns come first, and turns of equal number are
ordered by their ids; repeated rows are turns of their own; rows without a conv_id take no
part; an empty table has no nodes, not even a root. Extra columns are ignored. Very long texts are
hashed and counted in the JVM and not shuffled. A task's memory grows with its longest single
conversation (some 200 bytes a turn), not with their number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateflow.llm.common import written
from rateflow.llm.radix import Tree

WIDTH = 16  # bytes of a turn's id
RUN_BYTES = 1 << 19
# Fixed values of the contract: conversations of one block share their first turns.
BLOCK = 20
SHARED_TURNS = 4
_IDS_BITS = 12

_NODE = ("node_id binary, parent_id binary, conv_id bigint, parent_conv_id bigint, depth bigint, words bigint, n_convs bigint, "
         "n_children bigint, n_leaves bigint, saved_tokens bigint, inner_children bigint, inner_leaves bigint, inner_saved bigint, "
         "ends_sha256 string")


def conversations_as_keys(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): turns is the ordered array of (id as hex, words)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn",
                    # The length of the role tells where the text begins.
                    F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("id"),
                    F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))
    return (conversations.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("t"))
            .groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
            .select("conv_id", F.transform("t", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns")))


def rebuilt(lists: DataFrame, block: int = BLOCK, shared: int = SHARED_TURNS) -> DataFrame:
    """The conversations (conv_id, turns) with their first h turns, a number from 0 to shared - 1 by
    a hash of conv_id, replaced by those of the first conversation of their block."""
    base = F.col("conv_id") - F.col("conv_id") % block
    lead = lists.where(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, shared - 1).alias("lead"))  # serves ``block`` rows at most
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")
    none = F.slice("turns", 1, 0)
    turns = F.concat(F.slice(F.coalesce("lead", none), F.lit(1), F.col("h")),
                     F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0))))
    return (lists.withColumn("base", base).withColumn("h", h).join(lead, "base", "left")
            .select("conv_id", turns.alias("turns")))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of each class's ids from its pieces, which come one after the other."""
    current, state = None, None
    for batch in batches:
        cls, digest = [], []
        for c, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if c != current:
                if state is not None:
                    cls.append(current)
                    digest.append(state.hexdigest())
                current, state = c, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(cls, pa.binary()), pa.array(digest, pa.string())], names=["cls", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([state.hexdigest()], pa.string())],
                                         names=["cls", "ends_sha256"])


class Run:
    """The trie of a run of classes: rows (key, words, n, conv, ends)."""

    def __init__(self, rows: list[tuple], width: int = WIDTH):
        tree = Tree()
        for i, row in enumerate(rows):
            tree.insert(row[0], i)
        self.rows, self.width = rows, width
        self.parent, self.depth, self.end = [-1], [0], [-1]
        open_ = [0]  # the trie's nodes on the present path, by depth
        for at, edge, row in tree.walk():
            del open_[at // width + 1:]
            for d in range(at // width + 1, (at + len(edge)) // width + 1):
                self.parent.append(open_[-1])
                self.depth.append(d)
                self.end.append(-1)
                open_.append(len(self.parent) - 1)
            if row is not None:
                self.end[open_[-1]] = row

    def _path(self, row: int) -> dict[int, bytes]:
        """The nodes on the path of a row's key, with the hash of their prefixes."""
        node = self.end.index(row)
        on_path = []
        while node >= 0:
            on_path.append(node)
            node = self.parent[node]
        h, out = hashlib.md5(), {}
        key = self.rows[row][0]
        for d, node in enumerate(reversed(on_path)):
            if d:
                h.update(key[(d - 1) * self.width: d * self.width])
            out[node] = h.digest()
        return out

    def nodes(self) -> Iterator[tuple]:
        """Rows of _NODE."""
        size = len(self.parent)
        keys = [row[0] for row in self.rows]
        edge = self._path(keys.index(min(keys))) | self._path(keys.index(max(keys)))
        n, conv, some = [0] * size, [None] * size, [-1] * size
        children, leaves, saved, words = [0] * size, [0] * size, [0] * size, [0] * size
        inner = {i: [0, 0, 0] for i in edge}
        for i in range(size - 1, -1, -1):  # children come after their parents
            row = self.end[i]
            if row >= 0:
                some[i] = row
                n[i] += self.rows[row][2]
                conv[i] = self.rows[row][3] if conv[i] is None else min(conv[i], self.rows[row][3])
            if self.depth[i]:
                words[i] = self.rows[some[i]][1][self.depth[i] - 1]
            leaves[i] += not children[i]
            saved[i] += (n[i] - 1) * words[i]
            p = self.parent[i]
            if p >= 0:
                some[p] = some[i]
                n[p] += n[i]
                conv[p] = conv[i] if conv[p] is None else min(conv[p], conv[i])
                children[p] += 1
                leaves[p] += leaves[i]
                saved[p] += saved[i]
                if p in edge and i not in edge:
                    inner[p] = [x + y for x, y in zip(inner[p], (1, leaves[i], saved[i]))]
        for i, p in enumerate(self.parent):
            ends = self.rows[self.end[i]][4] if self.end[i] >= 0 else None
            yield (edge.get(i), edge.get(p), conv[i], conv[p] if p >= 0 and p not in edge else None, self.depth[i], words[i], n[i],
                   children[i], leaves[i], saved[i], *(inner[i] if i in edge else (None, None, None)), ends)


def _runs(run_bytes: int):
    schema = pa.schema([(c.split()[0], {"binary": pa.binary(), "bigint": pa.int64(), "string": pa.string()}[c.split()[1]])
                        for c in _NODE.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            if rows:
                columns = zip(*Run(rows).nodes())
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                rows.append(row)
                held += len(row[0]) + WIDTH
                if held >= run_bytes:
                    yield from flushed(rows)
                    rows, held = [], 0
        yield from flushed(rows)
    return run


def _subtree_sums(shared: DataFrame) -> DataFrame:
    """(node_id, n_leaves, saved_tokens) of the nodes of several runs (node_id, parent_id, depth,
    leaves, saved), where leaves and saved don't count children of that kind yet."""
    deepest = shared.agg(F.max("depth")).first()[0] or 0
    state = shared.select("node_id", F.col("parent_id").alias("up"), "leaves", "saved")
    reach = 1
    while reach <= deepest:
        # Each node holds the sum of those less than ``reach`` below it, and knows the one that far above.
        given = state.where("up is not null").groupBy(F.col("up").alias("node_id")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        further = state.where("up is not null").select(F.col("node_id").alias("up"), F.col("up").alias("next"))
        state = written(state.join(given, "node_id", "left").join(further, "up", "left").select(
            "node_id", F.col("next").alias("up"), (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "subtrees")
        reach *= 2
    return state.select("node_id", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


def trie(lists: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    """The nodes of the trie of conversations (conv_id, turns): conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    def joined(column: Column) -> Column:
        return F.array_join(column, ",")

    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    keyed = written(lists.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["words"]).alias("words"))
                    .withColumn("cls", F.unhex(F.md5("key"))), "keys")
    pieces = (keyed.groupBy("cls", F.shiftright("conv_id", _IDS_BITS).alias("piece"))
              .agg(joined(F.array_sort(F.collect_list("conv_id")).cast("array<string>")).alias("ids")))
    ends = (pieces.repartition("cls").sortWithinPartitions("cls", "piece").select("cls", "ids")
            .mapInArrow(_ends, "cls binary, ends_sha256 string"))
    classes = written(keyed.groupBy("cls", "key", "words").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv"))
                      .join(ends, "cls").select("key", "words", "n", "conv", "ends_sha256"), "classes")
    nodes = written(classes.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(_runs(run_bytes), _NODE), "nodes")

    first = ["parent_id", "depth", "words"]
    edges = written(
        nodes.where("node_id is not null").groupBy("node_id", *first).agg(
            F.count(F.lit(1)).alias("runs"), F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"),
            *(F.max(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens", "ends_sha256")),
            *(F.sum(c).alias(c) for c in ("inner_children", "inner_leaves", "inner_saved"))), "edge-nodes")
    # Children on the paths of runs: those of one run are complete, the others follow.
    complete = F.col("runs") == 1
    kids = edges.where("parent_id is not null").groupBy(F.col("parent_id").alias("node_id")).agg(
        F.count(F.lit(1)).alias("kids"), F.sum(F.when(complete, F.col("n_leaves")).otherwise(0)).alias("kid_leaves"),
        F.sum(F.when(complete, F.col("saved_tokens")).otherwise(0)).alias("kid_saved"))
    shared = written(edges.where(~complete).join(kids, "node_id", "left").select(
        "node_id", "parent_id", "depth", (F.col("inner_children") + F.coalesce("kids", F.lit(0))).alias("children"),
        (F.col("inner_leaves") + F.coalesce("kid_leaves", F.lit(0))).alias("leaves"),
        (F.col("inner_saved") + F.coalesce("kid_saved", F.lit(0)) + (F.col("n_convs") - 1) * F.col("words")).alias("saved")), "shared-nodes")
    sums = (shared.select("node_id", "children").join(_subtree_sums(shared), "node_id")
            .withColumnsRenamed({"n_leaves": "all_leaves", "saved_tokens": "all_saved"}))
    whole = (edges.join(sums, "node_id", "left")
             .withColumn("n_children", F.coalesce("children", "n_children"))
             .withColumn("n_leaves", F.coalesce("all_leaves", "n_leaves"))
             .withColumn("saved_tokens", F.coalesce("all_saved", "saved_tokens")))

    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
               F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")]
    names = edges.select(F.col("node_id").alias("parent_id"), F.col("conv_id").alias("above"))
    inside = nodes.where("node_id is null and parent_id is null")
    # Many nodes may hang on one path node: both sides are stored tables, so AQE can split it.
    hanging = nodes.where("node_id is null and parent_id is not null").join(names, "parent_id").withColumn("parent_conv_id", F.col("above"))
    on_paths = whole.join(names, "parent_id", "left").withColumn("parent_conv_id", F.col("above"))
    return inside.select(*columns).unionByName(hanging.select(*columns)).unionByName(on_paths.select(*columns))
