"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next one's docs. All but the last return the columns of documents.

1. quality classifier: documents that it rejects go.
2. n-gram Jaccard join: one document of each group stays, that of the least doc_id; five-word
   shingles, similarity 0.8 or more.
3. substring dedup: words that repeat earlier text go; documents without a word left go.
4. benchmark decontamination: documents that hold a benchmark passage go.
5. best-fit packing: what is left, as token sequences.

What a stage has written on the way is deleted when the next one begins, as by then its
result is stored.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm import decontaminate, jaccard, pack, quality, substrings
from rateflow.llm.common import drop_rows, fresh_name, id_filter, release_scratch, row_key, scratch_scope, table, written
from rateflow.session import scratch_path

SCOPE = "corpus-pipeline"


def _stage(function):
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_scratch(spark, SCOPE)
        with scratch_scope(SCOPE):
            return function(spark, docs, sf_dir)
    return run_stage


@_stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality.classify(docs, table(spark, sf_dir, "labels"))
    return drop_rows(docs, written(judged.where("not accepted").select("row_key"), "rejected"))


@_stage
def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = written(jaccard.join(docs, percent=80, size=5).select("row_key", "keeper", "n_shingles"), "groups")
    # Equal rows share a key; of those that would stay, one does.
    twice = written(found.where("keeper and n_shingles > 0").groupBy("row_key").count().where("count > 1").select("row_key"), "equal-rows")
    gone = found.where("not keeper").select("row_key").unionByName(twice)
    key = fresh_name(docs, "row_key")
    may_hold = id_filter(twice, "row_key")
    once = (docs.withColumn(key, row_key()).where(may_hold(F.col(key)))
            .join(twice.select(F.col("row_key").alias(key)), key, "left_semi").dropDuplicates([key]).select(*docs.columns))
    return drop_rows(docs, written(gone, "duplicates")).unionByName(once)


@_stage
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(docs, docs.columns).where("n_removed = 0 or kept <> ''")
    changed = F.col("n_removed") > 0
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return cut.select(*(F.when(changed, new[c]).otherwise(F.col("row")[c]).alias(c) if c in new else F.col("row")[c].alias(c)
                        for c in docs.columns))


@_stage
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return drop_rows(docs, written(found.where("n_hit > 0").select("row_key"), "contaminated"))


@_stage
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", jaccard_join),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

# Perplexity under a trained model and tokenisation are beyond SQL; tests hold the stages
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; the result is that of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
