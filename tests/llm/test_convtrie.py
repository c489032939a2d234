import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rateflow.llm import convtrie
from rateflow.llm.radix import DIRECT, INDEXED, MEDIUM, SMALL, Tree

SCHEMA = "conv_id long, turn long, role string, text string"


def _brute(rows):
    """Nodes of the rebuilt conversations, from a dictionary of all prefixes."""
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((t is not None, t or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [(r, x) for *_, r, x in sorted(ts)] for c, ts in turns.items()}
    full = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        full[c] = tuple(own.get(base, [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, ts in full.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[q] for q in children[p]) if children[p] else 1
        saved[p] = sum(saved[q] for q in children[p]) + (len(members[p]) - 1) * words
        ends = ",".join(str(c) for c in sorted(members[p]) if len(full[c]) == len(p))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]),
                    leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def _found(df, **options):
    lists = convtrie.rebuilt(convtrie.conversations_as_keys(df))
    rows = convtrie.trie(lists, **options).collect()
    return sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows),
                  key=lambda r: r[:2])


@given(st.lists(st.lists(st.integers(0, 5), max_size=6), max_size=40), st.integers(1, 3))
@settings(max_examples=200, deadline=None)
def test_tree_holds_keys_in_order(numbers, width):
    keys = [bytes(x) * width for x in numbers]
    tree = Tree()
    for i, k in enumerate(keys):
        tree.insert(k, i)
    got, path = [], b""
    for at, edge, value in tree.walk():
        path = path[:at] + edge
        if value is not None:
            got.append((path, value))
    assert got == sorted({k: i for i, k in enumerate(keys)}.items())


@pytest.mark.parametrize("n, room", [(4, SMALL), (5, MEDIUM), (16, MEDIUM), (17, INDEXED), (48, INDEXED), (49, DIRECT), (256, DIRECT)])
def test_layouts_grow(n, room):
    tree = Tree()
    order = list(range(n))
    random.Random(n).shuffle(order)
    for b in order:
        tree.insert(bytes([b, 7, 7]), b)
        tree.insert(bytes([b, 7, 7]), b)  # again: nothing new
    assert tree.root.room == room
    assert [e[0] for at, e, v in tree.walk() if v is not None] == list(range(n))
    assert all(tree.root.child(b).path == b"\x07\x07" for b in range(n))
    assert tree.root.child(n) is None if n < 256 else True


def test_compressed_paths_emit_turns():
    run = convtrie.Run([(b"aabbcc", [1, 2, 3], 2, 5, "x"), (b"aabd", [1, 4], 1, 9, "y")], width=2)
    rows = {(r[4], r[2]): r for r in run.nodes()}
    assert set(rows) == {(0, 5), (1, 5), (2, 5), (3, 5), (2, 9)}  # no node at the byte where bb and bd part
    root = rows[0, 5]
    assert root[6:10] == (3, 1, 2, 1 * 2 + 2 * 1 + 3 * 1)  # members, children, leaves, tokens


def _rows(seed, n, first=3):
    """Conversations of few different turns, with copies, hot beginnings and odd ones."""
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-60, 5 * n), n):
        size = r.choice([0, 1, 1, 2, 3, 5, 9])
        for t in range(size):
            word = r.randrange(first if t < 4 else 2)
            rows.append((c, None if t == 0 and r.random() < .2 else t, r.choice(["user", "user", None]), r.choice([None, "", "a b", "é x  y"]) if word == 0 else "w " * word))
    rows += [(20, 3, "u", "same"), (20, 3, "u", "same"), (20, 3, "u", "tie"), (None, 1, "u", "lost"), (7, 0, "us", "er"), (8, 0, "u", "ser")]
    return rows


@pytest.mark.parametrize("run_bytes", [1, 200, 1 << 19])
def test_trie_matches_brute_force(spark, run_bytes):
    rows = _rows(run_bytes, 300)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("clash")).withColumn("n", F.lit(1)).repartition(5)
    assert _found(df, run_bytes=run_bytes) == _brute(rows)


def test_many_copies_and_long_conversations(spark):
    # One group of copies of many ids, and long conversations that part late: deep paths over runs.
    rows = [(c * 20, t, "u", f"t{t}") for c in range(2000) for t in range(2)]
    rows += [(100_000 + c * 20, t, "u", f"x{t}" if t < 60 else f"{c}") for c in range(6) for t in range(62)]
    rows += [(200_000, t, "u", "long " * 20_000) for t in range(2)]
    assert _found(spark.createDataFrame(rows, SCHEMA).repartition(7), run_bytes=1500) == _brute(rows)


def test_turnless_conversations_are_members_of_the_root(spark):
    # Conversations whose turns all go and whose block has no first one.
    turnless = [c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4][:3]
    rows = [(c, 0, "u", "gone") for c in turnless]
    found = _found(spark.createDataFrame(rows, SCHEMA))
    assert found == _brute(rows) and found[0][1:4] == (0, None, len(turnless))


def test_empty_table(spark):
    assert _found(spark.createDataFrame([], SCHEMA)) == []
