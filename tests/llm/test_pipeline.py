"""Each stage on what the one before kept, against plain versions."""

import inspect

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from rateflow.llm import quality
from rateflow.llm.common import release_scratch, row_key, table
from rateflow.session import path_exists, scratch_path
from tests.conftest import SF_SMALL
from tests.llm.test_decontaminate import _brute as brute_hits
from tests.llm.test_jaccard import _brute as brute_groups
from tests.llm.test_repeats import _brute_words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before the first stage and after each."""
    out = [table(spark, SF_SMALL, "documents")]
    # A row twice, and one document again under other ids.
    first = out[0].orderBy("doc_id").limit(3)
    out[0] = out[0].unionByName(first).unionByName(first.selectExpr("doc_id + 5000 as doc_id", "text", "lang", "source", "n_chars"))
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, out[-1], SF_SMALL).write.parquet(path)
        out.append(spark.read.parquet(path))
    return [[r.asDict() for r in d.collect()] for d in out]


def test_stages_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "substring dedup",
                                                      "benchmark decontamination", "best-fit packing"]
    assert all(list(rows[0]) == COLUMNS for rows in stages[:-1]) and len(stages) == 6
    for _, stage in corpus_pipeline.STAGES:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]


def test_rejected_documents_go(spark, stages):
    docs = spark.createDataFrame([tuple(r.values()) for r in stages[0]], "doc_id long, text string, lang string, source string, n_chars long")
    judged = quality.classify(docs, table(spark, SF_SMALL, "labels"))
    kept = {r.row_key for r in judged.where("accepted").collect()}
    keyed = docs.withColumn("key", row_key()).collect()
    assert sorted(r.doc_id for r in keyed if r.key in kept) == sorted(r["doc_id"] for r in stages[1])
    assert 0 < len(stages[1]) < len(stages[0])


def test_one_document_of_each_group_stays(stages):
    component = {d: c for d, _, c in brute_groups([(r["doc_id"], r["text"]) for r in stages[1]], 80, 5)}
    ids = [r["doc_id"] for r in stages[2]]
    assert sorted(ids) == sorted(set(component.values()) | {d for d, c in component.items() if c is None})


def test_repeated_words_go(stages):
    expected = {d: (removed, kept) for d, _, removed, kept in _brute_words([(r["doc_id"], r["text"]) for r in stages[2]], 50)}
    before = {r["doc_id"]: r for r in stages[2]}
    got = {r["doc_id"]: r for r in stages[3]}
    assert set(got) == {d for d, (removed, kept) in expected.items() if kept or not removed}
    for d, r in got.items():
        removed, kept = expected[d]
        assert r["text"] == (kept if removed else before[d]["text"])
        assert r["n_chars"] == (len(kept) if removed else before[d]["n_chars"])


def test_contaminated_documents_go(stages):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF_SMALL}/benchmark.parquet'").fetchall()
    hits = {d: n for d, _, n, _ in brute_hits([(r["doc_id"], r["text"]) for r in stages[3]], items, 10)}
    assert {r["doc_id"] for r in stages[4]} == {d for d, n in hits.items() if not n}
    assert any(hits.values())


def test_all_that_is_left_is_packed(stages):
    pieces = stages[5]
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in stages[4]}
    ends = {}
    for r in pieces:
        assert 0 < r["length"] <= 2048 and r["start"] == 2048 * r["piece"]
        ends.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in ends.values():
        end = 0
        for offset, n in sorted(places):
            assert offset == end
            end += n
        assert end <= 2048


def test_scratch_of_a_stage_is_deleted_by_the_next(spark):
    from rateflow.llm import common
    docs = table(spark, SF_SMALL, "documents").limit(20)
    path = scratch_path(spark, "stage")
    corpus_pipeline.benchmark_decontamination(spark, docs, SF_SMALL).write.parquet(path)
    mine = list(common._WRITTEN[spark.sparkContext.applicationId, corpus_pipeline.SCOPE])
    assert mine and all(path_exists(spark, p) for p in mine)
    release_scratch(spark, corpus_pipeline.SCOPE)
    assert not any(path_exists(spark, p) for p in mine) and path_exists(spark, path)


def test_queries_are_registered():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()
    assert set(E.oracle_sql()) <= set(E.queries()) and corpus_pipeline.ORACLE_SQL is None
