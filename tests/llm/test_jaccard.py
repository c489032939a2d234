import random
import re

import numpy as np
import pyarrow as pa
import pytest

from rateflow.llm import jaccard as J
from rateflow.llm.components import components
from tests.llm.helpers import documents, no_documents


def _set(t, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset() if not w else frozenset([tuple(w)]) if len(w) < size else frozenset(zip(*(w[i:] for i in range(size))))


def _brute(docs, percent=90, size=3):
    s = [_set(t, size) for _, t in docs]
    parent = list(range(len(s)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(s)):
        for b in range(a):
            both = len(s[a] & s[b])
            if both and 100 * both >= percent * (len(s[a]) + len(s[b]) - both):
                parent[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s[i]), least.get(root(i))) for i, (d, _) in enumerate(docs)), key=repr)


def _documents(rnd, n):
    base = [f"w{rnd.randrange(4000)}" for _ in range(150)]
    docs = []
    for i in range(n):
        q = rnd.random()
        if q < 0.5:
            w = list(base)
            for _ in range(rnd.randint(0, 6)):
                w[rnd.randrange(len(w))] = f"x{rnd.randrange(50)}"
            w = w[: rnd.randint(130, 150)] if q < 0.1 else w
        elif q < 0.7 and docs:
            w = (rnd.choice(docs)[1] or "").split()
            for _ in range(rnd.randint(0, 2)):
                if w:
                    w[rnd.randrange(len(w))] = "Z"
        else:
            w = [f"w{rnd.randrange(30 if q < 0.8 else 4000)}" for _ in range(rnd.randint(0, 40))]
        docs.append((i, " ".join(w)))
    return docs + [(900, None), (901, ""), (902, " \t"), (903, "one"), (904, "ONE"), (905, "one two"), (906, "one  two"), (None, "one two"),
                   (None, "nothing like it"), (907, docs[0][1]), (907, docs[0][1]), (908, "long " * 20_000), (909, "long " * 19_000)]


@pytest.mark.parametrize("leaf, rounds, percent, size", [(500, 3, 90, 3), (8, 3, 90, 3), (8, 1, 90, 3), (500, 3, 80, 5), (8, 3, 80, 5)])
def test_against_brute_force(spark, monkeypatch, leaf, rounds, percent, size):
    for name, value in (("LEAF", leaf), ("ROUNDS", rounds), ("PIVOTS", 3), ("TOGETHER", 20)):
        monkeypatch.setattr(J, name, value)
    docs = _documents(random.Random(leaf + rounds), 250)
    got = J.join(documents(spark, docs), percent, size).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == _brute(docs, percent, size)
    kept = [r.component_id for r in got if r.keeper and r.n_shingles and r.doc_id not in (None, 907)]
    assert len(kept) == len(set(kept))


def _sets_of(*sets):
    s = object.__new__(J.Sets)
    values = [np.sort(J.T.mix(np.array(x, np.uint64))) for x in sets]
    s.values, s.text = np.concatenate(values), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    s.first = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    return s


@pytest.mark.parametrize("percent", [50, 80, 90, 99])
@pytest.mark.parametrize("few_parts, surplus", [(32, None), (0, None), (10 ** 6, None), (32, 1.0), (0, 1.0)])
def test_linked_sets_share_a_signature(monkeypatch, percent, few_parts, surplus):
    monkeypatch.setattr(J, "FEW_PARTS", few_parts)
    if surplus:
        monkeypatch.setattr(J, "part_surplus", lambda percent: surplus)
    rnd = random.Random(9)
    linked = 0
    for _ in range(400):
        n = rnd.choice([1, 2, 5, 8, 9, 10, 17, 40, 100, 300])
        a = rnd.sample(range(10 ** 6), n)
        most = n * (100 - percent) // percent + 1
        out = rnd.randint(0, min(n, most))
        b = a[out:] + rnd.sample(range(10 ** 6, 2 * 10 ** 6), rnd.randint(0, max(0, most - out)))
        both, union = len(set(a) & set(b)), len(set(a) | set(b))
        if not both or 100 * both < percent * union:
            continue
        linked += 1
        text, sig = J.signatures(_sets_of(a, b), percent)
        assert set(sig[text == 0].tolist()) & set(sig[text == 1].tolist())
    assert linked > 100


@pytest.mark.parametrize("percent, size", [(90, 3), (80, 5)])
def test_signatures_of_a_very_long_text_are_linear(percent, size):
    text = " ".join(f"w{i * i % 1_000_003}" for i in range(400_000)).encode()
    s = J.Sets(np.array([0, len(text)]), np.frombuffer(text, np.uint8), size)
    _, sig = J.signatures(s, percent)
    assert s.sizes()[0] > 300_000 and len(sig) < s.sizes()[0]


def _joined_by_blocks(spark, monkeypatch, texts, leaf):
    """Members that _by_blocks gets; the result is held against brute force."""
    for name, value in (("LEAF", leaf), ("PIVOTS", 3), ("TOGETHER", 20)):
        monkeypatch.setattr(J, name, value)
    got, plain = [], J._by_blocks

    def seen(members, *rest):
        got.append(members.count())
        return plain(members, *rest)

    monkeypatch.setattr(J, "_by_blocks", seen)
    docs = list(enumerate(texts))
    rows = J.join(documents(spark, docs), 80, 5).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr) == _brute(docs, 80, 5)
    assert len({r.component_id for r in rows}) < len(docs)
    return sum(got)


def test_members_of_a_chain_of_shares_are_not_all_compared(spark, monkeypatch):
    rnd = random.Random(4)
    words = [f"w{rnd.randrange(10 ** 6)}" for _ in range(2000)]
    texts = [" ".join(words[12 * i: 12 * i + 60]) for i in range(150)]
    texts += [t + " more" for t in texts[::10]]
    assert _joined_by_blocks(spark, monkeypatch, texts, 8) == 0


def test_a_family_below_the_threshold_is_joined_by_blocks(spark, monkeypatch):
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(10 ** 6)}" for _ in range(200)]
    texts = []
    for _ in range(60):
        w = list(base)
        for _ in range(12):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10 ** 6)}"
        texts.append(" ".join(w))
    texts += [t + " more" for t in texts[::10]]
    assert _joined_by_blocks(spark, monkeypatch, texts, 30) > 0


def test_signatures_are_not_stored(spark, monkeypatch):
    rows, plain = {}, J.written

    def seen(df, name):
        out = plain(df, name)
        rows[name] = max(rows.get(name, 0), out.count())
        return out

    monkeypatch.setattr(J, "written", seen)
    rnd = random.Random(6)
    docs = [(i, " ".join(f"w{rnd.randrange(10 ** 6)}" for _ in range(300))) for i in range(40)]
    docs += [(100 + i, t + " more") for i, t in docs[:20]]
    J.join(documents(spark, docs)).collect()
    assert max(rows.values()) <= 2 * len(docs), rows


@pytest.mark.parametrize("bits", [0, 3, 16])
def test_packed_signatures_link_what_shares_one(monkeypatch, bits):
    rnd = random.Random(bits)
    monkeypatch.setattr(J, "PACKED", 300)
    base = [" ".join(f"w{rnd.randrange(10 ** 6)}" for _ in range(40)) for _ in range(30)]
    texts = base + ["", "one"] + [t + " more" for t in base[:20]] * 2
    nodes = [rnd.choice([-1, 1]) * rnd.randrange(1 << 62) for _ in texts]
    batches = [pa.RecordBatch.from_arrays([pa.array(nodes[i: i + 7], pa.int64()), pa.array(texts[i: i + 7])], names=["row_key", "text"])
               for i in range(0, len(texts), 7)]
    out = pa.Table.from_batches(J._signatures(3, 80, bits)(iter(batches)))
    assert out.num_rows > 1 << bits
    links = [tuple(x) for _, g in out.to_pandas().groupby("shard") for x in J._shared(g).to_numpy().tolist()]
    of_sig = {}
    for node, text in zip(nodes, texts):
        data = text.encode()
        for sig in J.signatures(J.Sets(np.array([0, len(data)]), np.frombuffer(data, np.uint8), 3), 80)[1].tolist():
            of_sig.setdefault(sig, set()).add(node)

    def components_of(pairs):
        label = {n: n for n in nodes}
        for a, b in pairs:
            old, new = label[a], label[b]
            label = {n: new if x == old else x for n, x in label.items()}
        return {frozenset(n for n in nodes if label[n] == x) for x in label.values()}

    assert components_of(links) == components_of((min(s), n) for s in of_sig.values() for n in s)
    assert J._shared(out.slice(0, 0).to_pandas()).empty


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(1, i) for i in range(2, 60)]
    edges = spark.createDataFrame(chain + star + [(5, 5), (2, 1), (60, 61)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {i: 1 for i in range(1, 60)} | {60: 60, 61: 60}
    assert components(edges.limit(0)).collect() == []


def test_no_documents(spark):
    assert J.join(no_documents(spark)).collect() == []
