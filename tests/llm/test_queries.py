"""The registered queries on the smallest tables, against SQL or plain versions."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from rateflow.llm.oracle import ORACLE_SQL
from rateflow.llm.pack import default_vocabulary
from rateflow.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.test_jaccard import _brute as brute_groups
from tests.llm.test_licenses import _plain
from tests.llm.test_repeats import _brute_bytes


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def texts(con):
    return con.sql("SELECT doc_id, text FROM documents").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    got, expected = QUERIES[name](spark, SF_SMALL), con.sql(ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    at = [expected.columns.index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr) == \
        sorted((tuple(r[i] for i in at) for r in expected.fetchall()), key=repr)


def test_op1_on_held_out_documents(spark, con):
    lang = dict(con.sql("SELECT doc_id, lang FROM documents").fetchall())
    rows = QUERIES["op1_language_id"](spark, SF_SMALL).collect()
    assert {r.doc_id: r.held_out for r in rows} == {d: zlib.crc32(str(d).encode()) % 4 == 2 for d in lang}
    held = [r for r in rows if r.held_out]
    assert held and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_op5_components(spark, texts):
    got = QUERIES["op5_jaccard_join"](spark, SF_SMALL).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_groups(texts)


def test_op6_bytes(spark, texts):
    got = QUERIES["op6_suffix_array_dedup"](spark, SF_SMALL).collect()
    expected = [(d, n, gone, spans, hashlib.sha256(kept).hexdigest()) for d, n, gone, spans, kept in _brute_bytes(texts, 100)]
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(expected)


def test_op7_keeps_clean_documents(spark, con):
    labels = dict(con.sql("SELECT doc_id, min(quality) FROM labels GROUP BY 1").fetchall())
    accepted = {r.doc_id: r.accepted for r in QUERIES["op7_quality_classifier"](spark, SF_SMALL).collect()}
    good = [accepted[d] for d, q in labels.items() if q == 1]
    bad = [accepted[d] for d, q in labels.items() if q == 0]
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.5


def test_op9_pieces(spark, texts):
    library = Tokenizer.from_file(default_vocabulary())
    expected = {}
    for d, t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        for i in range(0, len(ids), 2048):
            part = np.array(ids[i: i + 2048], "<u4")
            expected[d, i // 2048] = (i, len(part), zlib.crc32(part.tobytes()))
    got = QUERIES["op9_best_fit_packing"](spark, SF_SMALL).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == expected
    least = -(-sum(n for _, n, _ in expected.values()) // 2048)
    assert least <= len({r.sequence_id for r in got}) <= least + 1


def test_op10_licences(spark, texts):
    rows = {r.doc_id: r for r in QUERIES["op10_license_scan"](spark, SF_SMALL).collect()}
    assert {d: r.n_sentences for d, r in rows.items()} == {d: len(_plain(t)) for d, t in texts}
    assert any(r.licenses for r in rows.values())
