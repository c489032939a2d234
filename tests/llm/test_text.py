import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from rateflow.llm import text as T

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB1 .\t\n é-\x0b", max_size=20)), min_size=1, max_size=6)


def _found(texts, keep, lower):
    batch = pa.record_batch({"text": pa.array(texts, pa.string())})
    out = []
    for rows, offsets, data in T.row_chunks(batch, size=16):
        w = T.words(offsets, T.lower_ascii(data) if lower else data, keep)
        out += [w.joined(int(a), int(b)).split(" ") if a < b else [] for a, b in zip(w.first, w.first[1:])]
    return out


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_patterns(texts):
    lowered = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in texts]
    assert _found(texts, T.NOT_BLANK, False) == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert _found(texts, T.ALNUM, True) == [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t) for t in lowered]


def test_winnowing_keeps_the_least_of_every_window():
    rnd = random.Random(5)
    for _ in range(100):
        n = rnd.randint(0, 200)
        first = np.array(sorted([0, n, *(rnd.randint(0, n) for _ in range(3))]))
        k, w = rnd.randint(1, 6), rnd.randint(1, 9)
        g = T.gram_hashes(T.mix(np.array([rnd.randint(1, 4) for _ in range(n)], np.uint64)), k)
        expected = set()
        for a, b in zip(first, first[1:]):
            for s in range(a, b - (w + k - 1) + 1):
                expected.add(-min((int(g[i]) >> 24, -i) for i in range(s, s + w))[1])
        assert T.winnow(g, first, k, w).tolist() == sorted(expected)


def test_equal_spans_have_equal_hashes():
    data = np.frombuffer(b"abcabcab", np.uint8)
    h = T.byte_span_hashes(data, np.array([0, 3, 1, 0]), np.array([3, 6, 3, 8]))
    assert h[0] == h[1] and len(set(h.tolist())) == 3
