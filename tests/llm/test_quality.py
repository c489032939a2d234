import numpy as np
import pytest
from pyspark.sql import functions as F

from rateflow.llm import quality
from tests.llm.helpers import documents, no_documents

LABELS = "doc_id long, quality int, toxic int"
WORDS = "the of and that this with thing other there where from about".split()


def test_junk_goes_and_clean_text_stays(spark):
    rnd = np.random.default_rng(2)
    clean = [(i, " ".join(rnd.choice(WORDS, 40)) + ".", "en") for i in range(120)]
    junk = [(200 + i, " ".join(f"{w}$$#{i}" for w in rnd.choice(WORDS, 40)), "en") for i in range(10)]
    junk += [(300, " ".join(rnd.choice(WORDS, 40)).upper(), "en")]
    other = [(400, None, "en"), (401, "", "en"), (402, "the other thing", None), (403, "the other thing and that", "xx"),
             (None, "the other thing", "en"), (404, "this and that with other things there", "en"),
             (404, "this and that with other things there", "en")]
    docs = documents(spark, clean + junk + other)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(i, 0, 0) for i in range(200, 205)] + [(5, 0, 0), (None, 1, 0)], LABELS)
    rows = quality.classify(docs, labels, lowest=0.0, highest=1.0).collect()
    assert len(rows) == docs.count()
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    assert sum(got[i][0].accepted for i in range(120)) >= 110
    assert all(got[i][0].accepted for i in range(60) if i != 5)  # they set the quantiles
    assert not any(got[i][0].accepted for i in [*range(200, 210), 300, 400, 401])
    assert got[400][0].bits is None and got[401][0].bits is None
    assert got[402][0].grp == got[403][0].grp == quality.ALL and got[1][0].grp == "en"
    assert all(r.least <= r.bits <= r.most for r in rows if r.accepted)
    assert got[404][0] == got[404][1] and None in got


def test_no_labels_and_no_rows(spark):
    none = spark.createDataFrame([], LABELS)
    rows = quality.classify(documents(spark, [(1, "abc"), (2, "")]), none).collect()
    assert {(r.doc_id, r.accepted) for r in rows} == {(1, True), (2, False)}
    assert quality.classify(no_documents(spark), none).collect() == []


def test_clean_text_of_a_language_with_one_trusted_document_stays(spark):
    rnd = np.random.default_rng(3)
    docs = documents(spark, [(i, " ".join(rnd.choice(WORDS, 40)) + ".", "en" if i < 150 else "xx") for i in range(180)])
    labels = spark.createDataFrame([(i, 1, 0) for i in [*range(100), 150]], LABELS)
    rows = quality.classify(docs, labels, lowest=0.0, highest=1.0).collect()
    few = [r for r in rows if r.doc_id >= 150]
    assert {r.grp for r in few} == {"xx"} and sum(r.accepted for r in few) >= 27
    # Trusted documents lie among the others, not below them.
    mean = [np.mean([r.bits for r in rows if a <= r.doc_id < b]) for a, b in ((0, 100), (100, 150))]
    assert abs(mean[0] - mean[1]) < 0.05


def test_limits_against_plain_arithmetic(spark):
    """Means, variances and quantiles by language, and a language that one document more
    changes by little."""
    rnd = np.random.default_rng(4)
    rows = [(i, "en" if i < 60 else "fr" if i < 70 else None, float(b), float(b) + 0.1) for i, b in enumerate(rnd.normal(2, 0.2, 80))]
    scored = spark.createDataFrame(rows, "doc_id long, lang string, bits double, bits_all double")
    trusted = spark.range(80).select(F.col("id").alias("doc_id"))
    got = {r.grp: r for r in quality.limits(scored, trusted, 0.0, 1.0).collect()}
    every = np.array([r[3] for r in rows])
    z = []
    for grp, lang in (("en", "en"), ("fr", "fr"), (quality.ALL, None)):
        own = np.array([r[2] for r in rows if r[1] == lang])
        w = len(own) / (len(own) + quality.PRIOR) if lang else 0.0
        mean = w * own.mean() + (1 - w) * every.mean()
        spread = np.sqrt(w * own.var() + (1 - w) * every.var() + w * (1 - w) * (own.mean() - every.mean()) ** 2)
        if not lang:
            mean, spread = every.mean(), every.std()
        assert (got[grp].mean, got[grp].spread) == (pytest.approx(mean), pytest.approx(spread))
        z += ((own - mean) / spread).tolist()
    assert got["en"].q == [pytest.approx(min(z)), pytest.approx(max(z))]
    fewer = {r.grp: r for r in quality.limits(scored.where("doc_id <> 69"), trusted, 0.0, 1.0).collect()}
    assert abs(fewer["fr"].mean - got["fr"].mean) < 0.05 and abs(fewer["fr"].spread - got["fr"].spread) < 0.05
