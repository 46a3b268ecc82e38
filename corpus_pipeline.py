"""Documents to training sequences: five stages, each written and read again.

1. quality      documents that the quality classifier rejects go
2. copies       of each group of near copies, the smallest doc_id stays
3. benchmark    documents that hold a benchmark item go
4. personal     personal data, and terms that disclose it, are masked in the text
5. sequences    best-fit packing; one row per piece of a document

Every stage works on all rows that its predecessor kept, and all but the last
return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adgleaner.llm import classifier, decontaminate, jaccard_join, packing, pii
from adgleaner.llm.common import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = classifier.fit(docs, table(spark, sf_dir, "labels"))
    return classifier.keep_good(docs, model).select(*COLUMNS)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs).select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`n_chars` stays the length of the document as it came."""
    return pii.Scan(docs, everywhere=True).sanitised().select(*COLUMNS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("copies", copies),
    ("benchmark", benchmark),
    ("personal", personal),
    ("sequences", sequences),
]

# The classifier's scores come from training, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
