"""Benchmark items inside long documents: MinHash containment search, partitioned by size.

An item is found in a document if at least `threshold` per cent of its distinct
five-word shingles occur there. A document may be a thousand times as long as an
item, so that MinHash, which estimates Jaccard similarity, sees next to nothing
of it. Two steps mend that:

- A shingle that no item has takes no part in any containment. Documents are
  reduced to their shingles that some item has, by a semi join.
- The reduced documents are partitioned by size, items too. Within a pair of
  partitions the containment wanted means a Jaccard similarity of at least some
  j, and ceil(log(miss) / log(1 - j)) hash functions find such a pair but for a
  chance of `miss`. Larger documents get more functions; none is left out.

Documents and items that share a minimum are candidates; these are verified by
counting the shingles they share.

Words are runs of letters and digits in lower case. A text of fewer than five
words has one shingle, all of it; null and empty texts have none and match
nothing. Repeated rows are found once. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from adgleaner.llm.common import written

WIDTH = 5


def _hashes(w: Column) -> Column:
    """64-bit hashes of the shingles of a list of words, in order."""
    several = F.transform(
        F.sequence(F.lit(0), F.size(w) - WIDTH), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WIDTH)])
    )
    one = F.array(F.xxhash64(F.array_join(w, " ")))
    return F.when(F.size(w) >= WIDTH, several).when(F.size(w) > 0, one).otherwise(F.array().cast("array<bigint>"))


def _shingled(rows: DataFrame, keep: list[str], text: str) -> DataFrame:
    """One row per shingle. The words are a column of their own, so that they are cut once."""
    w = F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return rows.select(*keep, w.alias("w")).select(*keep, F.explode(_hashes(F.col("w"))).alias("shingle"))


def functions_needed(threshold: int, most: int, least: int, miss: float) -> int:
    """Hash functions for documents of up to `most` shingles and items of at least `least`."""
    t = threshold / 100
    j = t / (1 - t + most / least)
    return math.ceil(math.log(miss) / math.log1p(-min(j, 0.999)))


def find(
    docs: DataFrame,
    items: DataFrame,
    threshold: int = 75,
    miss: float = 1e-9,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """`doc_id, item_id, n_shared, n_item` of every document and item it contains."""
    item = written(
        _shingled(items.select("item_id", F.col("text").alias("text")), ["item_id"], "text").distinct(), "bench-items"
    )
    universe = written(item.select("shingle").distinct(), "bench-universe")
    source = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("h"), F.col(text).alias("text")
    )
    reduced = written(
        _shingled(source, ["doc_id", "h"], "text").join(universe, "shingle", "left_semi").distinct(), "bench-reduced"
    )
    n_item = item.groupBy("item_id").agg(F.count("*").alias("n_item"))
    n_doc = reduced.groupBy("doc_id", "h").agg(F.count("*").alias("n_doc"))
    band = lambda n: F.floor(F.log2(n)).cast("int")
    # One row per power of two: some dozens at most.
    bands = [r.band for r in n_doc.select(band(F.col("n_doc")).alias("band")).distinct().collect()]
    least = n_item.agg(F.min("n_item").alias("n")).first().n or 1
    k_of = {x: functions_needed(threshold, 2 ** (x + 1) - 1, 2 ** int(math.log2(least)), miss) for x in bands} or {0: 1}
    k = F.create_map(*[F.lit(v) for pair in k_of.items() for v in pair])
    doc_minima = _minima(_with_size(reduced, n_doc).withColumn("k", k[band(F.col("n_doc"))]), ["doc_id", "h"])
    item_minima = written(_minima(item.withColumn("k", F.lit(max(k_of.values()))), ["item_id"]), "bench-minima")
    candidates = doc_minima.join(item_minima, ["function", "least_hash"]).select("doc_id", "h", "item_id").distinct()
    pairs = candidates.join(item, "item_id")
    shared = (
        pairs.alias("p")
        .join(
            reduced.alias("r"),
            (F.col("p.shingle") == F.col("r.shingle"))
            & (F.col("p.h") == F.col("r.h"))
            & F.col("p.doc_id").eqNullSafe(F.col("r.doc_id")),
        )
        .groupBy("p.doc_id", "p.h", "p.item_id")
        .agg(F.count("*").alias("n_shared"))
        .join(n_item, "item_id")
    )
    enough = shared.where(100 * F.col("n_shared") >= threshold * F.col("n_item"))
    return enough.groupBy("doc_id", "item_id").agg(F.max("n_shared").alias("n_shared"), F.first("n_item").alias("n_item"))


def _with_size(reduced: DataFrame, n_doc: DataFrame) -> DataFrame:
    r, n = reduced.alias("r"), n_doc.alias("n")
    same = (F.col("r.h") == F.col("n.h")) & F.col("r.doc_id").eqNullSafe(F.col("n.doc_id"))
    return r.join(n, same).select("r.doc_id", "r.h", "shingle", "n_doc")


def _minima(rows: DataFrame, keep: list[str]) -> DataFrame:
    """The least hash of the shingles of each text under each of its first k functions."""
    each = rows.select(*keep, "shingle", F.explode(F.sequence(F.lit(1), F.col("k"))).alias("function"))
    value = F.xxhash64("function", "shingle")
    return each.groupBy(*keep, "function").agg(F.min(value).alias("least_hash"))


def without_items(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that contain no item, all columns as they were."""
    found = written(find(docs, items, **options).select(F.col("doc_id").alias("_found")).distinct(), "bench-found")
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_found"]), "left_anti")
