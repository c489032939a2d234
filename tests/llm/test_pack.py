import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from rateflow.llm import pack
from tests.llm.helpers import documents, no_documents

TEXTS = ["Plain text, with punctuation. And more!", "Don't they'll WE'VE", "café naïve Über ÇA ß ñandú", "é W̊ combining",
         "1 22 3.5 x2y", "漢字 かな “quotes” — dash…", "<|endoftext|> inside<|startoftext|>x", "tab\tnew\nline\x0b\x1c\x85　end",
         "emoji 😀👍🏽 ok", "İstanbul ΣΑΣ ﬁ", "a" * 300, "", "   ", "hy-phen snake_case a.b.c e.g.", "हिन्दी पाठ العربية"]


def test_ids_are_those_of_the_library():
    from rateflow.llm.tokenize import WordEncoder
    library = Tokenizer.from_file(pack.default_vocabulary())
    encoder = WordEncoder(pack.default_vocabulary(), cache_size=40)
    rnd = random.Random(1)
    for _ in range(4):
        texts = TEXTS + [" ".join(rnd.choice(TEXTS) for _ in range(3)) for _ in range(20)]
        for text, ids in zip(texts, encoder.encode([t.encode() for t in texts])):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


# What white space, lower-casing, normalising and the vocabulary's rules treat in their own ways.
ATOMS = ["mot", "Été", "»", "«", "”", "—", "…", "€", "😀", "İ", "i̇", "ß", "é", "e\u0301", "\u00a0", "\u3000", "\u0085", "\u200b", "\u00ad",
         ".", "!!", "...", "'s", "'LL", "23", "٣", "²", "½", "漢字", "한글", "नमस्ते", "\x00", "\x01", "\x7f", "\t", "\n", " ", " ", "(", ")", "ª",
         "_", "ŉ", "ﬁ", "Ǆ", "ΑΣ", "\u0345", "\ufeff", "\u200d", "<", "<|", "Ⅷ", "\u2028", "\x1c"]


@pytest.mark.parametrize("cache_size", [1, 300_000])
def test_ids_do_not_depend_on_texts_before(cache_size):
    """Random texts in two orders, with caches that are cold and warm."""
    from rateflow.llm.tokenize import WordEncoder
    library = Tokenizer.from_file(pack.default_vocabulary())
    rnd = random.Random(cache_size)
    texts = ["« mot »", "Il dit « mot ».", "»", "it.”", "(—)", "wait...…", "great!!😀"] + \
        ["".join(rnd.choice(ATOMS) for _ in range(rnd.randrange(1, 8))) for _ in range(3000)]
    expected = {t: library.encode(t, add_special_tokens=False).ids for t in texts}
    encoder = WordEncoder(pack.default_vocabulary(), cache_size=cache_size)
    for _ in range(2):
        rnd.shuffle(texts)
        for i in range(0, len(texts), 50):
            part = texts[i: i + 50]
            for text, ids in zip(part, encoder.encode([t.encode() for t in part])):
                assert np.frombuffer(ids, "<u4").tolist() == expected[text], text


def test_texts_of_known_pieces_are_looked_up_once(monkeypatch):
    """No set of pieces is built for them, and the library isn't asked."""
    from rateflow.llm.tokenize import WordEncoder
    encoder = WordEncoder(pack.default_vocabulary())
    texts = [t.encode() for t in ("Don't they'll WE'VE 1 22 it's", "naïve été, d'accord", "plain. 's 'x ''s")]
    first = encoder.encode(texts)
    asked = []
    monkeypatch.setattr(encoder, "_plain", asked.extend)
    assert encoder.encode(texts) == first and not asked
    counted = []

    class Counting(dict):
        def __contains__(self, key):
            counted.append(key)
            return super().__contains__(key)
    encoder.ids = Counting(encoder.ids)
    assert encoder.encode(texts) == first and not counted


def _best_fit(items, capacity):
    free = []
    for s in sorted(items, reverse=True):
        fits = [i for i, r in enumerate(free) if r >= s]
        if fits:
            i = min(fits, key=free.__getitem__)
            free[i] -= s
        else:
            free.append(capacity - s)
    return len(free)


def test_plans_are_whole_and_no_worse_than_best_fit():
    rnd = random.Random(2)
    for t in range(300):
        capacity = rnd.choice([10, 20, 64, 2048])
        items = [rnd.randint(1, capacity if t % 3 else max(2, capacity // 3)) for _ in range(rnd.randint(0, 150))]
        rows, sequences = pack.plan(dict(Counter(items)), capacity)
        held, ranks = {}, Counter()
        for size, rank, n, first, offset in rows.tolist():
            for i in range(n):
                held.setdefault(first + i, []).append((offset, size))
                ranks[size, rank + i] += 1
        assert ranks == Counter((s, i) for s, n in Counter(items).items() for i in range(n))
        assert set(held) == set(range(sequences))
        for pieces in held.values():
            end = 0
            for offset, size in sorted(pieces):
                assert offset == end
                end += size
            assert end <= capacity
        assert sequences <= _best_fit(items, capacity)


def test_reduction_finds_the_optimum_where_best_fit_does_not():
    # Exact pairs: 6+4, 6+4, 7+3, 7+3; best-fit also finds these, and so on for dominated sets.
    assert pack.plan({6: 2, 4: 2, 7: 2, 3: 2}, 10)[1] == 4
    assert pack.plan({10: 5, 9: 1, 5: 3}, 10)[1] == 8


@pytest.mark.parametrize("capacity", [16, 2048])
def test_pieces_and_places(spark, capacity):
    rnd = random.Random(3)
    docs = [(i, rnd.choice(TEXTS) + " " + rnd.choice(TEXTS)) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "word " * 9000), (103, TEXTS[0]), (103, TEXTS[0]), (None, TEXTS[1])]
    library = Tokenizer.from_file(pack.default_vocabulary())
    expected = Counter()
    for d, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        for i in range(0, len(ids), capacity):
            part = ids[i: i + capacity]
            expected[d, i // capacity, i, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part)] += 1
    got = pack.pack(documents(spark, docs), capacity, with_ids=True).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in got) == expected
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        end = 0
        for offset, n in sorted(pieces):
            assert offset == end
            end += n
        assert end <= capacity
    lengths = [k[3] for k in expected.elements()]
    assert -(-sum(lengths) // capacity) <= len(sequences) <= _best_fit(lengths, capacity)


def test_no_documents(spark):
    assert pack.pack(no_documents(spark)).collect() == []


def test_one_length_over_many_buckets(spark, monkeypatch):
    # Ranks of a single length come from small buckets, whose sizes are summed in two levels.
    monkeypatch.setattr(pack, "RANKED_TOGETHER", 2)
    monkeypatch.setattr(pack, "BUCKETS_TOGETHER", 3)
    rows = [(i, " ".join(["word"] * 9)) for i in range(60)] + [(100 + i, "a b") for i in range(31)] + [(7, "a b")] * 3
    got = pack.pack(documents(spark, rows), capacity=20).collect()
    assert len(got) == len(rows) and Counter(r.length for r in got) == {10: 60, 3: 34}
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in held.values():
        ends = [0]
        for offset, length in sorted(pieces):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 20
    assert len(held) == 30 + -(-34 // 6)
