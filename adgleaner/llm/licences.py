"""Licence scan by digests of canonical texts.

A text is brought to a canonical form (case, copyright lines, punctuation and
equivalent spellings), hashed, and joined to the digests of known licences. Only
entire texts meet: the whole document, and each of its lines, which is how works
name their licence. Known texts are a table, so its size decides the join.

Defined results: null and empty texts, and texts that are copyright lines only,
have the digest of the empty text, which is no licence; repeated rows give
repeated rows; ties between licences of one digest go to the first by name.
Other columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adgleaner.llm.licence_texts import KNOWN, SAME_WORD

# A line that begins with "copyright" or a sign for it, up to its end.
COPYRIGHT_LINE = r"(?im)^[^a-z0-9\n]*(?:copyright|copr\.|\(c\)|©)[^\n]*$"
NOT_WORD = r"[^\p{L}\p{N}]+"
_VARIANT = r" (?:" + "|".join(a for a, _ in SAME_WORD) + r") "


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, words with single blanks, one spelling per word."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), COPYRIGHT_LINE, "")
    spaced = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(plain), NOT_WORD, " ")), F.lit(" "))
    # Two blanks between words while spellings are replaced, so that neighbours do not share one.
    same = F.replace(spaced, F.lit(" "), F.lit("  "))
    for variant, compared in SAME_WORD:
        same = F.replace(same, F.lit(f" {variant} ".replace(" ", "  ")), F.lit(f"  {compared}  "))
    return F.trim(F.when(spaced.rlike(_VARIANT), F.replace(same, F.lit("  "), F.lit(" "))).otherwise(spaced))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known_licences(spark: SparkSession, texts: Iterable[tuple[str, str]] = KNOWN) -> DataFrame:
    """`digest, licence`: one row per digest."""
    rows = spark.createDataFrame(list(texts), "licence string, text string")
    found = rows.select(digest(F.col("text")).alias("digest"), "licence")
    return found.where(found.digest != F.sha2(F.lit("").cast("binary"), 256)).groupBy("digest").agg(
        F.min("licence").alias("licence")
    )


def scan(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the whole text's digest and licence, and the licences its lines name, in order of name.

    Rows are not regrouped: lines are looked up one by one and gathered per row,
    keyed by id and digest, so that equal rows share one lookup.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    whole = base.select("doc_id", F.xxhash64("text").alias("t"), digest(F.col("text")).alias("digest"))
    lines = base.select(
        "doc_id", F.xxhash64("text").alias("t"), F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line")
    )
    notices = (
        lines.select("doc_id", "t", digest(F.col("line")).alias("digest"))
        .join(known, "digest")
        .groupBy("doc_id", "t")
        .agg(F.array_sort(F.collect_set("licence")).alias("notices"), F.count("*").alias("n_notices"))
    )
    found = whole.join(known.withColumnRenamed("licence", "whole_licence"), "digest", "left").alias("w")
    n = notices.alias("n")
    return found.join(
        n, F.col("w.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("w.t") == F.col("n.t")), "left"
    ).select(
        "w.doc_id",
        F.col("digest").alias("text_digest"),
        "whole_licence",
        F.coalesce(F.array_join("n.notices", ","), F.lit("")).alias("notices"),
        F.coalesce("n.n_notices", F.lit(0)).cast("long").alias("n_notices"),
    )
