import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from rateflow.llm import oddsketch as O
from rateflow.llm import text as T
from rateflow.llm.jaccard import Sets
from tests.llm.helpers import documents, no_documents


def _shingles(text, size=4):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ")
             .replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i: i + size]) for i in range(len(words) - size + 1)}


def brute(rows, percent=80, size=4):
    """(doc_id, n_shingles, component_id, kept) from all pairs that share a shingle."""
    sets = [_shingles(t, size) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    shared = defaultdict(int)
    for h in holders.values():
        for a in range(len(h)):
            for b in range(a):
                shared[h[b], h[a]] += 1
    for (a, b), both in shared.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            parent[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        known = [x for x in (least.get(root(i)), d) if x is not None]
        least[root(i)] = min(known) if known else None
    out = [(d, len(s), least[root(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]
    return sorted(((d, n, c, d == c) for d, n, c in out), key=repr)


def _found(df, **options):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in O.near_duplicates(df, **options).collect()), key=repr)


def _sets(texts, size=4):
    offsets, data = T.string_parts(pa.array(texts, pa.string()))
    return Sets(offsets, data, size)


def _edited(r, words, share):
    return [f"e{r.random()}" if r.random() < share else w for w in words]


def test_samples_agree_as_often_as_sets_are_similar():
    r = random.Random(3)
    for n in (1, 3, 10, 60, 300, 3000):
        base = [f"w{r.random()}" for _ in range(n + 3)]
        texts = [" ".join(base)] + [" ".join(_edited(r, base, e)) for e in (0.02, 0.05, 0.2) for _ in range(30)]
        s = _sets(texts)
        table = O.samples(s)
        assert (table != O._EMPTY).all()
        errors, jaccard, estimates = [], [], []
        odd = O.sketches(table)
        for d in range(1, len(texts)):
            a, b = _shingles(texts[0]), _shingles(texts[d])
            j = len(a & b) / len(a | b)
            errors.append((table[0] == table[d]).mean() - j)
            x = int(np.bitwise_count(odd[0] ^ odd[d]).sum())
            jaccard.append(j)
            estimates.append(O.estimate(x))
            assert j < 0.8 or x <= O.most_bits(80)
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05
        high = [(j, e) for j, e in zip(jaccard, estimates) if j > 0.6]
        assert all(abs(j - e) < 0.2 for j, e in high)
    assert O.estimate(0) == 1 and O.estimate(O.SKETCH_BITS / 2) == 0
    # Unrelated sets are far beyond the bound.
    s = _sets([" ".join(f"w{r.random()}" for _ in range(200)) for _ in range(20)])
    odd = O.sketches(O.samples(s))
    assert min(int(np.bitwise_count(odd[0] ^ o).sum()) for o in odd[1:]) > O.most_bits(80)


def test_samples_do_not_depend_on_neighbours():
    texts = ["a b c d e f", None, "a", "x y z w v", "a b c d e f"]
    together = O.samples(_sets(texts))
    for i, t in enumerate(texts):
        assert (O.samples(_sets([t]))[0] == together[i]).all()
    assert (together[0] == together[4]).all() and (together[1] == O._EMPTY).all()


def _corpus(seed, families=12):
    """Near copies of all grades, chains, templates below the threshold, copies and odd texts."""
    r = random.Random(seed)
    rows = []
    for f in range(families):
        base = [f"w{r.randrange(400)}" for _ in range(r.choice([1, 3, 4, 5, 9, 30, 120, 400]))]
        for _ in range(r.choice([1, 3, 8])):
            rows.append(" ".join(_edited(r, base, r.choice([0, 0.01, 0.03, 0.06, 0.1]))))
        chain = list(base)
        for _ in range(5):
            chain = chain[1:] + [f"c{r.random()}"]
            rows.append(" ".join(chain))
    template = [f"t{i}" for i in range(100)]
    rows += [" ".join(template + [f"f{r.random()}" for _ in range(22)]) for _ in range(25)]  # about 0.7 alike, not linked
    rows += ["same text of a few words here"] * 5 + ["SAME text of a few words here", None, "", " \t", "one", "one", "é ü ß ö"]
    r.shuffle(rows)
    ids = r.sample(range(1000), len(rows))
    return [*zip(ids, rows), (None, "same text of a few words here"), (None, "nobody else has this text at all"), (7, rows[0]), (7, rows[0])]


@pytest.mark.parametrize("leaf, percent, size", [(O.LEAF, 80, 4), (3, 80, 4), (O.LEAF, 90, 3)])
def test_near_duplicates_match_brute_force(spark, monkeypatch, leaf, percent, size):
    monkeypatch.setattr(O, "LEAF", leaf)  # small: open bands go to pairs of blocks
    rows = _corpus(leaf)
    assert _found(documents(spark, rows), percent=percent, size=size) == brute(rows, percent, size)


def test_links_beside_the_centres(spark, monkeypatch):
    # Families whose members are not linked with most centres: found within bands, by blocks.
    monkeypatch.setattr(O, "LEAF", 4)
    r = random.Random(9)
    template = [f"t{i}" for i in range(100)]
    rows = []
    for _ in range(12):
        own = template + [f"f{r.random()}" for _ in range(24)]
        rows += [" ".join(own), " ".join([*own, "extra"]), " ".join(own[:-1])]
    rows = list(zip(r.sample(range(500), len(rows)), rows))
    found = _found(documents(spark, rows))
    assert found == brute(rows) and len({c for _, _, c, _ in found}) == 12


def test_bound_of_estimates():
    # The band bound of the docstring, and six deviations above the threshold's expectation.
    assert (1 - 0.8 ** O.BAND_ROWS) ** (O.SAMPLES // O.BAND_ROWS) < 2e-9
    assert O.estimate(O.most_bits(80)) < 0.65
    assert O.most_bits(100) < O.most_bits(90) < O.most_bits(80)


def test_empty_and_very_long_texts(spark):
    assert _found(no_documents(spark)) == []
    long = " ".join(f"w{i}" for i in range(400_000))
    rows = [(5, long), (3, long + " more"), (1, "short"), (9, long[: len(long) // 2])]
    found = _found(documents(spark, rows))
    assert [(d, c, k) for d, _, c, k in found] == [(1, 1, True), (3, 3, True), (5, 3, False), (9, 9, True)]
