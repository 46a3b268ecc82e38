"""The registered queries of this package. `ORACLES` has their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from adgleaner.llm import classifier, decontaminate, jaccard_join, licences, mask_search, packing, pii, quality_rules
from adgleaner.llm import prefix_trees, prefix_trie, secret_forest, suffix_dedup, warc
from adgleaner.llm.common import table
from adgleaner.llm.oracles import ORACLES


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", "kept")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed(table(spark, sf_dir, "documents")).drop("kept")


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"), licences.known_licences(spark))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = pii.Scan(table(spark, sf_dir, "documents"), everywhere=True).spans()
    counts = [pii.count_of(F.col("base"), kind).cast("long").alias(f"n_{kind}") for kind in pii.KINDS[:4]]
    base = pii.span_text(F.col("base"))
    return spans.select(
        "doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), pii.span_text(F.col("all")).alias("spans")
    )


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classifier.classify(docs, classifier.fit(docs, table(spark, sf_dir, "labels")))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_forest.scan(spark, table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_copies(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_prefix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = prefix_trees.removed(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.summary(table(spark, sf_dir, "conversations"))


def op13_mask_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_suffix_dedup,
        op3_licences,
        op4_personal_data,
        op5_quality_classifier,
        op6_best_fit_packing,
        op7_warc,
        op8_secrets,
        op9_jaccard_join,
        op10_decontamination,
        op11_prefix_trees,
        op12_prefix_trie,
        op13_mask_search,
    )
}
