"""One query per operator, over its whole table with production parameters, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm import (convtrie, decontaminate, fim, jaccard, langid, licenses, oddsketch, pack, quality, substrings,
                          suffixes, topk, warc)
from rateflow.llm.common import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return (langid.identify(table(spark, sf_dir, "documents"), "crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2")
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "accepted"))


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (warc.archive(table(spark, sf_dir, "pages"))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (suffixes.remove_repeats(table(spark, sf_dir, "documents"), ["doc_id"])
            .select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
            .select("doc_id", "n_scored", "perplexity", "accepted"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (substrings.remove_repeats(table(spark, sf_dir, "documents"), ["doc_id"])
            .select("row.doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (licenses.scan(table(spark, sf_dir, "documents"))
            .select("doc_id", F.array_join("licenses", ",").alias("licenses"), F.size("sentences").alias("n_sentences"),
                    F.size("unmatched").alias("n_unmatched")))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convtrie.trie(convtrie.rebuilt(convtrie.conversations_as_keys(table(spark, sf_dir, "conversations"))))


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oddsketch.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digest(fim.transform(table(spark, sf_dir, "documents")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_topk_search": op2_topk_search,
    "op3_warc": op3_warc,
    "op4_decontaminate": op4_decontaminate,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_license_scan": op10_license_scan,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_minhash_dedup": op12_minhash_dedup,
    "op13_fill_in_middle": op13_fill_in_middle,
    "pipeline": pipeline,
}
