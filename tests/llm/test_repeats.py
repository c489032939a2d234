import hashlib
import random

import pytest

from rateflow.llm import substrings, suffixes
from tests.llm.helpers import documents, no_documents


def _rows(rnd, words):
    common = [" ".join(rnd.choice(words) for _ in range(n)) for n in (8, 12, 15, 40)]
    docs = []
    for i in range(150):
        t = " ".join(rnd.choice(words) + str(rnd.randint(0, 30)) for _ in range(rnd.randint(0, 20)))
        for _ in range(rnd.randint(0, 3)):
            t += " " + rnd.choice(common) + " " + " ".join(rnd.choice("abé") for _ in range(rnd.randint(0, 6)))
        if i % 9 == 0:
            t += " As" * rnd.randint(1, 40)
        if i % 4 == 0 and docs:
            t = rnd.choice(docs)[1]
        docs.append((i, t))
    return docs + [(900, None), (901, ""), (902, "a " * 6000), (903, docs[3][1]), (903, docs[3][1]), (None, docs[5][1]), (None, "only here " * 9)]


def _order(d):
    return (d is None, d or 0)


def _brute_words(docs, window):
    first = {}
    for d, t in docs:
        w = (t or "").encode().split()
        for i in range(len(w) - window + 1):
            key = tuple(w[i: i + window])
            first[key] = min(_order(d), first.get(key, _order(d)))
    out = []
    for d, t in docs:
        w = (t or "").encode().split()
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i: i + window])] < _order(d):
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_words_against_brute_force(spark, monkeypatch, seed):
    for name, value in (("BLOCK", 16), ("SHARD", 60), ("STREAMED", 100)):
        monkeypatch.setattr(substrings, name, value)
    docs = _rows(random.Random(seed), ["w%d" % i for i in range(40)])
    got = substrings.remove_repeats(documents(spark, docs), ["doc_id"], window=10, k=4).collect()
    assert sorted(((r.row.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=repr) == _brute_words(docs, 10)


def test_matching_statistics_of_an_automaton():
    rnd = random.Random(6)
    for _ in range(200):
        reference = [(rnd.randint(0, 9), [rnd.randint(0, 3) for _ in range(rnd.randint(1, 30))]) for _ in range(rnd.randint(1, 5))]
        query, window, order = [rnd.randint(0, 3) for _ in range(40)], rnd.randint(1, 6), rnd.randint(0, 10)
        held = {}
        for o, s in reference:
            for i in range(len(s) - window + 1):
                held[tuple(s[i: i + window])] = min(o, held.get(tuple(s[i: i + window]), o))
        hit = set()
        for i in range(len(query) - window + 1):
            if held.get(tuple(query[i: i + window]), 99) < order:
                hit.update(range(i, i + window))
        spans = substrings.Automaton(reference).spans(query, order, window)
        assert {i for a, b in spans for i in range(a, b)} == hit


def _brute_bytes(docs, window):
    seen, out = set(), []
    for d, t in sorted(docs, key=lambda x: _order(x[0])):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if b[i: i + window] in seen:
                gone[i: i + window] = b"\1" * window
            seen.add(b[i: i + window])
        runs = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [3, 4])
def test_bytes_against_brute_force(spark, monkeypatch, seed):
    # Small ranges, so that common passages are split over several.
    monkeypatch.setattr(suffixes, "RANGE", 40)
    monkeypatch.setattr(suffixes, "MAX_HOT", 10 ** 9)
    docs = [r for r in _rows(random.Random(seed), ["abc", "de", "fé"]) if r[0] not in (903, None)]
    got = suffixes.remove_repeats(documents(spark, docs), ["doc_id"], window=30, k=10).collect()
    assert sorted(((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=repr) == _brute_bytes(docs, 30)


def test_equal_rows_and_null_ids_of_byte_dedup(spark):
    docs = [(1, "x" * 5 + "abcdefghij" * 4), (1, "x" * 5 + "abcdefghij" * 4), (None, "abcdefghij" * 4), (2, "abcdefghij" * 4), (3, None)]
    got = suffixes.remove_repeats(documents(spark, docs), ["doc_id"], window=30, k=10).collect()
    by_id = {}
    for r in got:
        by_id.setdefault(r.row.doc_id, []).append((r.n_bytes, r.n_removed))
    # Within a text the string repeats from its tenth byte on; the equal rows are one document.
    assert by_id == {1: [(45, 30)] * 2, 2: [(40, 40)], None: [(40, 40)], 3: [(0, 0)]}


def test_merge_of_front_coded_runs():
    rnd = random.Random(8)
    for _ in range(200):
        runs = [sorted(bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(0, 12)))
                for _ in range(rnd.randint(1, 6))]
        coded = [suffixes.decode_run(*suffixes.front_code(r)) for r in runs]
        merged = list(suffixes.merge_runs(coded))
        assert [k for _, k, _ in merged] == sorted(k for r in runs for k in r)
        last = b""
        for _, k, n in merged:
            assert n == suffixes.common_prefix(last, k)
            last = k
        # The runs' own orders are kept.
        for i, r in enumerate(runs):
            assert [k for j, k, _ in merged if j == i] == r


def test_no_documents(spark):
    assert substrings.remove_repeats(no_documents(spark), ["doc_id"]).collect() == []
    assert suffixes.remove_repeats(no_documents(spark), ["doc_id"]).collect() == []


def test_whole_texts_are_read(spark):
    """A passage at the far end of a long text is found."""
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(1, passage), (2, " ".join(f"u{i}" for i in range(150_000)) + " " + passage)]
    words = {r.row.doc_id: r.n_removed for r in substrings.remove_repeats(documents(spark, docs), ["doc_id"]).collect()}
    assert words == {1: 0, 2: 60}
    data = {r.row.doc_id: (r.n_removed, hashlib.sha256(bytes(r.kept)).hexdigest())
            for r in suffixes.remove_repeats(documents(spark, docs), ["doc_id"]).collect()}
    assert data[2] == (len(passage), hashlib.sha256(docs[1][1][: -len(passage)].encode()).hexdigest()) and data[1][0] == 0


def test_near_copy_of_one_of_many_that_share_a_passage(spark, monkeypatch):
    """A hot passage fills whole ranges; near copies end it early and sort outside of them."""
    monkeypatch.setattr(suffixes, "RANGE", 40)
    monkeypatch.setattr(suffixes, "MAX_HOT", 10 ** 9)
    rnd = random.Random(12)
    passage = "".join(rnd.choice("abcdefgh") for _ in range(60))
    docs = [(i, "".join(rnd.choice("klmnopqr") for _ in range(40)) + passage) for i in range(200)]
    for i, x in enumerate(rnd.sample(docs, 40)):
        docs.append((1000 + i, x[1][:40 + 22] + rnd.choice("AZaz") * 12))
    got = suffixes.remove_repeats(documents(spark, docs), ["doc_id"], window=30, k=10).collect()
    assert sorted(((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=repr) == _brute_bytes(docs, 30)
