"""Word vectors from a corpus: words that stand in the same company get like vectors.

Spark counts which words stand near each other; the positive pointwise mutual information of
these counts is reduced by a randomised singular value decomposition whose products of the large
matrix run as Spark jobs. Texts and labels can then meet without sharing a word.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from adgleaner.session import shared_folder

# Executors need no copy of this module: the helper travels with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What a task holds before it reduces it or passes it on.
_HELD = 1_000_000
_PAIRS_HELD = 4_000_000
_PIECE = 100_000


def words_of(text: str | None) -> list[str]:
    return re.findall(r"\w+", text.lower()) if text else []


@dataclass(frozen=True)
class WordVectors:
    """Words, their vectors, and how much each weighs in a text: rare words more than common ones."""

    words: tuple[str, ...]
    vectors: np.ndarray
    weights: np.ndarray

    @cached_property
    def places(self) -> dict[str, int]:
        return {w: i for i, w in enumerate(self.words)}

    def of(self, text: str | None) -> np.ndarray | None:
        """Weighted sum of the vectors of a text's words; NULL if none of them is known by its company."""
        known = [self.places[w] for w in words_of(text) if w in self.places]
        if not known:
            return None
        place, n = np.unique(known, return_counts=True)
        total = (n * self.weights[place]) @ self.vectors[place]
        return total if total.any() else None

    def embed(self, text: Column) -> Column:
        @F.arrow_udf("array<double>")
        def apply(batch: pa.Array) -> pa.Array:
            return pa.array([self.of(t) for t in batch.to_pylist()], pa.list_(pa.float64()))

        return apply(text)


def _frequent_words(texts: DataFrame, text: str, least: int, most: int) -> list[tuple[str, int]]:
    """The `most` words with the highest counts; equal counts by word. Tasks add up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for t in batch.column(0):
                held.update(words_of(t.as_py()))
                if len(held) > _HELD:
                    yield pa.RecordBatch.from_pydict({"word": list(held), "n": list(held.values())})
                    held = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    counted = texts.select(text).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    top = counted.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(most)
    return [(r.word, r.n) for r in top.collect()]


def _added(pairs: tuple[np.ndarray, ...], counts: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, and the sums of their counts."""
    pair, place = np.unique(np.concatenate(pairs), return_inverse=True)
    return pair, np.bincount(place, np.concatenate(counts), len(pair)).astype(np.int64)


def _pair_counts(texts: DataFrame, text: str, places: dict[str, int], window: int) -> DataFrame:
    """(a, b, n): how often two known words stand at most `window` known words apart, both ways.

    A pair is counted once, as one number with the lesser place first, and turned round when all are added up.
    """
    size = len(places)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0
        # Distinct pairs of parts that are done, with their counts; added up when there are many.
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def rows() -> pa.RecordBatch:
            added = _added(*zip(*parts)) if parts else [np.empty(0, np.int64)] * 2
            return pa.RecordBatch.from_arrays([pa.array(c) for c in added], ["pair", "n"])

        for batch in batches:
            for t in batch.column(0):
                ids = np.array([i for i in map(places.get, words_of(t.as_py())) if i is not None], np.int64)
                # A very long text goes in pieces; a pair belongs to the piece of its first word.
                for start in range(0, len(ids), _PIECE):
                    for step in range(1, window + 1):
                        second = ids[start + step : start + step + _PIECE]
                        first = ids[start : start + len(second)]
                        held.append(np.minimum(first, second) * size + np.maximum(first, second))
                        n_held += len(second)
                    if n_held > _HELD:
                        parts.append(np.unique(np.concatenate(held), return_counts=True))
                        held, n_held = [], 0
                        if sum(len(p) for p, _ in parts) > _PAIRS_HELD:
                            parts = [_added(*zip(*parts))]
                            if len(parts[0][0]) > _PAIRS_HELD // 2:
                                yield rows()
                                parts = []
        if held:
            parts.append(np.unique(np.concatenate(held), return_counts=True))
        yield rows()

    once = texts.select(text).mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    a, b = F.expr(f"pair div {size}"), F.expr(f"pair % {size}")
    # A word next to itself counts both ways too.
    n = F.when(a == b, 2 * F.col("n")).otherwise(F.col("n"))
    ways = F.array(F.struct(a.alias("a"), b.alias("b"), n.alias("n")), F.struct(b.alias("a"), a.alias("b"), n.alias("n")))
    return once.select(F.inline(F.when(a == b, F.slice(ways, 1, 1)).otherwise(ways)))


def _information(pairs: DataFrame) -> DataFrame:
    """(a, bs, values): one row per word with what it says of its neighbours, where that is positive.

    The totals are one row per known word, and so is the result, so that both are bounded by
    the number of known words; the totals are sent to every task.
    """
    totals = pairs.groupBy("a").agg(F.sum("n").alias("n_a"))
    of_b = totals.select(F.col("a").alias("b"), F.col("n_a").alias("n_b"))
    everything = totals.agg(F.sum("n_a").cast("double").alias("total"))
    joined = pairs.join(F.broadcast(totals), "a").join(F.broadcast(of_b), "b")
    total = everything.first()["total"] or 0.0
    value = F.log(F.col("n") * F.lit(total) / F.col("n_a") / F.col("n_b"))
    rows = joined.select("a", "b", value.alias("value")).where("value > 0").groupBy("a")
    entries = rows.agg(F.array_sort(F.collect_list(F.struct("b", "value"))).alias("e"))
    return entries.select("a", F.col("e.b").alias("bs"), F.col("e.value").alias("values"))


def _product(matrix: DataFrame, by: np.ndarray) -> np.ndarray:
    """The matrix times a narrow one. Each row is computed whole in one task, always in the same order."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (np.asarray(v.values) @ by[np.asarray(b.values)]).tobytes() for b, v in zip(batch.column(1), batch.column(2))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["a", "row"])

    out = np.zeros(by.shape)
    # One row per known word, from all tasks at once.
    for r in matrix.mapInArrow(multiply, "a bigint, row binary").collect():
        out[r.a] = np.frombuffer(r.row)
    return out


def learn(
    texts: DataFrame,
    text: str = "text",
    dims: int = 64,
    window: int = 5,
    least: int = 3,
    most_words: int = 50_000,
    rounds: int = 2,
    seed: int = 7,
) -> WordVectors:
    """Vectors of the `most_words` most frequent words that occur at least `least` times.

    All texts are counted. What reaches the driver or a task is at most `most_words` rows of `dims`
    numbers, whatever the corpus. The same texts and seed give the same vectors. Null and empty
    texts count for nothing; without words the result knows none.
    """
    frequent = _frequent_words(texts, text, least, most_words)
    words = tuple(w for w, _ in frequent)
    counts = np.array([n for _, n in frequent], float)
    weights = 1 / (1 + 1000 * counts / counts.sum()) if words else counts
    if not words:
        return WordVectors(words, np.zeros((0, dims)), weights)
    spark = texts.sparkSession
    pairs, matrix = shared_folder(spark, "pairs"), shared_folder(spark, "information")
    _pair_counts(texts, text, {w: i for i, w in enumerate(words)}, window).write.parquet(pairs)
    _information(spark.read.parquet(pairs)).write.parquet(matrix)
    table = spark.read.parquet(matrix)
    # Random directions, turned towards the strongest ones by each product; the matrix is symmetric.
    width = min(dims + 8, len(words))
    basis = np.random.default_rng(seed).standard_normal((len(words), width))
    for _ in range(rounds + 1):
        basis = np.linalg.qr(_product(table, basis))[0]
    left, strength, _ = np.linalg.svd(_product(table, basis), full_matrices=False)
    vectors = left[:, :dims] * np.sqrt(strength[:dims])
    return WordVectors(words, vectors, weights)
