import numpy as np
import pytest

from rateflow.llm import charlm, langid
from tests.llm.helpers import documents, no_documents

WORDS = {"en": "the of and that this with thing other".split(), "de": "der die und nicht ein für über schön".split()}


def _text(rnd, lang, n=30):
    return " ".join(rnd.choice(WORDS[lang], n))


@pytest.fixture(scope="module")
def docs(spark):
    rnd = np.random.default_rng(1)
    rows = [(i, _text(rnd, "en" if i % 2 else "de"), "en" if i % 2 else "de") for i in range(80)]
    rows += [(80, None, "en"), (81, "", "en"), (82, "12 !?", None), (83, "the other thing", None), (None, "und über", "de"),
             (84, "the the the", "en"), (84, "the the the", "en"), (85, "und " * 30_000, "de"), (86, "𐐷𐐷 漢字 the", None)]
    return documents(spark, rows)


def test_predictions(docs):
    rows = langid.identify(docs, "doc_id % 4 <> 2").collect()
    assert len(rows) == docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    for i in range(80):
        assert by_id[i][0].lang_pred == ("en" if i % 2 else "de") and 0.5 < by_id[i][0].score <= 1
    for i in (80, 81, 82):
        assert (by_id[i][0].lang_pred, by_id[i][0].score, by_id[i][0].accepted) == ("und", 0.0, False)
    assert by_id[83][0].lang_pred == "en" and by_id[85][0].lang_pred == "de"
    assert by_id[None][0].lang_pred == "de" and not by_id[None][0].learned
    assert len(by_id[84]) == 2 and by_id[84][0] == by_id[84][1]


def test_foreign_text_is_not_accepted(spark, docs):
    odd = documents(spark, [(1000 + 4 * i + 2, "zxqv qzkx xvvq kqzz " * 5, None) for i in range(3)])
    rows = langid.identify(docs.unionByName(odd), "doc_id % 4 <> 2").where("doc_id >= 1000").collect()
    assert len(rows) == 3 and not any(r.accepted for r in rows) and all(r.lang_pred in ("en", "de") for r in rows)


def test_nothing_learned_and_no_rows(spark):
    rows = langid.identify(documents(spark, [(1, "the", None)]), "true").collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)]
    assert langid.identify(no_documents(spark), "true").collect() == []


@pytest.mark.parametrize("modified", [False, True])
def test_probabilities_against_plain_kneser_ney(spark, modified):
    """The model's probabilities equal those of a direct implementation, and sum to 1."""
    texts = ["abab abba", "baab ab", "abc"]
    counts = charlm.count_grams(spark.createDataFrame([("g", t) for t in texts], "grp string, text string"), letters_only=False)
    model = charlm.train(counts, modified)
    pad = "   "
    tables = [{}]
    top = {}
    for t in texts:
        s = pad + t
        for i in range(3, len(s)):
            top[s[i - 3: i + 1]] = top.get(s[i - 3: i + 1], 0) + 1
    orders = {4: top}
    for o in (3, 2, 1):
        orders[o] = {}
        for g in orders[o + 1]:
            orders[o][g[1:]] = orders[o].get(g[1:], 0) + 1
    del tables

    def discount(o, c):
        n = [max(1, sum(v == k for v in orders[o].values())) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        d = (1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]) if modified else (y, y, y)
        d = [min(max(x, 0.05), m) for x, m in zip(d, (0.95, 1.9, 2.9))]
        return min(d[min(c, 3) - 1], c)

    def p(o, g):
        if o == 0:
            return 1 / (len(orders[1]) + 1)
        same = {k: c for k, c in orders[o].items() if k[:-1] == g[:-1]}
        if not same:
            return p(o - 1, g[1:])
        total = sum(same.values())
        weight = sum(discount(o, c) for c in same.values()) / total
        c = same.get(g, 0)
        return (c - (discount(o, c) if c else 0)) / total + weight * p(o - 1, g[1:])

    def packed(g):
        v = 0
        for ch in g:
            v = v << 16 | ord(ch)
        return v

    grams = [h + c for h in ("   ", "aba", "bab", "zzz", "zab") for c in "abc z"]
    got = np.exp(model.log_p("g", np.array([packed(g) for g in grams], np.uint64)))
    assert got == pytest.approx([p(4, g) for g in grams], rel=1e-4)
    # Over the characters met and one unknown, the probabilities of a context add up to 1.
    every = np.exp(model.log_p("g", np.array([packed("aba" + c) for c in "abc z"], np.uint64)))
    assert every.sum() == pytest.approx(1, rel=1e-4)


def test_no_gram_is_taken_for_another(spark):
    """With very many grams learned, a gram that was never seen still backs off."""
    rnd = np.random.default_rng(5)
    codes = rnd.integers(0x4E00, 0x9FA5, 400_000)
    texts = ["".join(map(chr, part)) for part in np.split(codes, 100)]
    counts = charlm.count_grams(spark.createDataFrame([("g", t) for t in texts], "grp string, text string"), letters_only=False)
    model = charlm.train(counts, False)
    # Contexts that were never seen: only the last character counts.
    last = ord(texts[0][0])
    grams = np.array([(0x3400 + i) << 48 | 0x3400 << 32 | 0x3400 << 16 | last for i in range(200)], np.uint64)
    got = model.log_p("g", grams)
    assert np.ptp(got) == 0 and np.exp(got[0]) < 0.01


def test_many_languages(spark):
    """There is no limit on the number of lang values."""
    docs = documents(spark, [(i, f"{chr(0x4E00 + i) * 9} the", f"l{i}") for i in range(410)])
    rows = langid.identify(docs, "true").collect()
    assert len(rows) == 410 and all(r.lang_pred == f"l{r.doc_id}" for r in rows)


def _units(text):
    raw = text.encode("utf-16-le")
    return [int.from_bytes(raw[i: i + 2], "little") for i in range(0, len(raw), 2)]


@pytest.mark.parametrize("head_bytes", [0, 400, charlm.HEAD_BYTES])
def test_scores_are_sums_of_the_probabilities(spark, monkeypatch, head_bytes):
    """Whatever the sorted arrays hold, a text's score is the sum over its grams, one by one."""
    monkeypatch.setattr(charlm, "HEAD_BYTES", head_bytes)
    learned = [("a", "abab abba 𐐷𐐸"), ("a", "baab ab"), ("b", "xyxx yxy 𑌀")]
    model = charlm.train(charlm.count_grams(spark.createDataFrame(learned, "grp string, text string"), letters_only=False), True)
    texts = ["abba", "", "xyx zzz", "𐐷𐐸 𐌀𑌀", "ab " * 500, "abba"]
    docs = spark.createDataFrame([("", (i,), t) for i, t in enumerate(texts)], "grp string, row struct<i int>, text string")
    got = {r.row.i: r for r in charlm.score(docs, charlm.EachGroup(model, ["a", "b"]), letters_only=False).collect()}
    packed = {}
    for i, t in enumerate(texts):
        units = [32, 32, 32, *_units(t)]
        packed[i] = [(units[k - 3] << 48) | (units[k - 2] << 32) | (units[k - 1] << 16) | units[k] for k in range(3, len(units))]
        assert got[i].n == len(packed[i])
    distinct = sorted({g for gs in packed.values() for g in gs})
    for j, group in enumerate("ab"):
        value = dict(zip(distinct, model.log_p(group, np.array(distinct, np.uint64))))
        for i, grams in packed.items():
            assert got[i].sums[j] == pytest.approx(sum(value[g] for g in grams), abs=1e-4)
    assert got[0].sums == got[5].sums


def test_wide_characters_are_kept_apart():
    """Letters beyond 16 bits that agree in their low bits give different grams; signs are blanks."""
    def grams(text, letters_only=True):
        data = np.frombuffer(text.encode(), np.uint8)
        return charlm.Grams(np.array([0, len(data)]), data, letters_only)
    assert set(grams("𑌅").grams.tolist()).isdisjoint(grams("𐌅").grams.tolist())
    assert grams("a😀b").grams.tolist() == grams("a b").grams.tolist()
    assert grams("😀").has_letter.tolist() == [False] and grams("𐌅").has_letter.tolist() == [True]
