"""Quality classifier: hashed word and character n-gram vectors, averaged, softmax.

Each document is the mean of the vectors of its features: words, pairs of
neighbouring words, and character n-grams within a word and its outer blanks,
all hashed into one table of buckets. Vectors and output layer are learnt by
stochastic gradient descent in numpy on the driver, from a sample of labelled
rows whose size is bounded by `max_docs` and `max_chars`. As the mean and the
output layer are linear, a document's score needs only one number per bucket,
so executors get a table of fixed size and score whole texts in Arrow batches.

Defined results: null or empty text has no features and scores by the bias
alone; with labels of one kind, or none, every score is the smoothed share of
label 1; repeated rows score alike; of two labels for one id the larger counts;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

_MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)
_BASE_INV = np.uint64(pow(0x100000001B3, -1, 1 << 64))
# A longer text is cut at a blank after so many characters.
_CHUNK = 1 << 19
# Characters of several texts, and rows of a batch, that are handled at a time: an executor's memory
# holds some 200 bytes a character for each of its tasks.
_GROUP = 1 << 16
_ROWS = 200
_BLANK = 0x20


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    dim: int = 8
    char_ngrams: tuple[int, ...] = (3, 4)
    epochs: int = 6
    rate: float = 0.3
    max_docs: int = 4000
    max_chars: int = 24_000_000
    seed: int = 7


@dataclass
class Model:
    settings: Settings
    # Log-odds of label 1 that one feature of each bucket adds to the mean.
    weights: np.ndarray = field(repr=False)
    bias: float = 0.0


def _code_points(text: str) -> np.ndarray:
    a = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    a[(a == 32) | ((a >= 9) & (a <= 13))] = _BLANK
    return a


def _pieces(a: np.ndarray) -> Iterator[np.ndarray]:
    """Cuts of a long text, each at the first blank after the size of a chunk."""
    start = 0
    while len(a) - start > _CHUNK:
        blanks = np.flatnonzero(a[start + _CHUNK :] == _BLANK)
        if not len(blanks):
            break
        end = start + _CHUNK + int(blanks[0])
        yield a[start:end]
        start = end
    yield a[start:]


def _powers(n: int, base: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, dtype=np.uint64)]))


def _features(texts: list[np.ndarray], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Document number and bucket of every feature of some texts."""
    gap = np.array([_BLANK], dtype=np.uint64)
    parts = [gap]
    for t in texts:
        parts += [t, gap]
    a = np.concatenate(parts)
    sizes = np.array([len(t) + 1 for t in texts])
    doc = np.repeat(np.arange(len(texts)), sizes)
    doc = np.concatenate([doc, doc[-1:]])  # of the character after each position
    shift = np.uint64(64 - s.bits)
    blank = a == _BLANK
    seen = np.concatenate([[0], np.cumsum(blank)])
    docs, buckets = [], []
    with np.errstate(over="ignore"):
        h = a.copy()
        for n in range(2, max(s.char_ngrams) + 1):
            if len(a) < n:
                break
            h = h[: len(a) - n + 1] * _BASE + a[n - 1 :]
            if n in s.char_ngrams:
                at = np.flatnonzero(seen[n - 1 : len(a)] == seen[1 : len(a) - n + 2])
                docs.append(doc[at])
                buckets.append(((h[at] + np.uint64(n)) * _MULT) >> shift)
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        start, end = edge[::2], edge[1::2]
        if len(start):
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(a * _powers(len(a), _BASE))])
            word = (total[end] - total[start]) * _powers(len(a), _BASE_INV)[start]
            of = doc[start - 1]
            docs.append(of)
            buckets.append(((word ^ _BASE) * _MULT) >> shift)
            near = np.flatnonzero(of[1:] == of[:-1])
            # A word after itself is one feature, whatever the word.
            pair = np.where(word[near] == word[near + 1], np.uint64(1), (word[near] * _BASE) ^ word[near + 1])
            docs.append(of[near])
            buckets.append(((pair + np.uint64(99)) * _MULT) >> shift)
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(docs), np.concatenate(buckets).astype(np.int64)


def _chunks(texts: list[str | None]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Texts in groups of bounded size, with their numbers."""
    ids, group, size = [], [], 0
    for i, t in enumerate(texts):
        for piece in _pieces(_code_points(t)) if t else ():
            if group and size + len(piece) > _GROUP:
                yield ids, group
                ids, group, size = [], [], 0
            ids.append(i)
            group.append(piece)
            size += len(piece)
    if group:
        yield ids, group


def log_odds(texts: list[str | None], model: Model) -> np.ndarray:
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for ids, group in _chunks(texts):
        doc, bucket = _features(group, model.settings)
        at = np.asarray(ids)
        np.add.at(total, at, np.bincount(doc, weights=model.weights[bucket], minlength=len(group)))
        np.add.at(count, at, np.bincount(doc, minlength=len(group)))
    return total / np.maximum(count, 1) + model.bias


def train(texts: list[str | None], labels: np.ndarray, s: Settings = Settings()) -> Model:
    """Learn from texts and labels 0 or 1."""
    size = 1 << s.bits
    ones = int(labels.sum())
    prior = np.log((ones + 1) / (len(labels) - ones + 1))
    if not 0 < ones < len(labels):
        return Model(s, np.zeros(size, np.float32), float(prior))
    bags: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.float32))] * len(texts)
    for ids, group in _chunks(texts):
        doc, bucket = _features(group, s)
        key, count = np.unique(doc * size + bucket, return_counts=True)
        cut = np.searchsorted(key, np.arange(len(group) + 1) * size)
        for j, i in enumerate(ids):
            k, c = key[cut[j] : cut[j + 1]] % size, count[cut[j] : cut[j + 1]].astype(np.float32)
            if len(bags[i][0]):  # a later piece of a long text
                k, back = np.unique(np.concatenate([bags[i][0], k]), return_inverse=True)
                c = np.bincount(back, weights=np.concatenate([bags[i][1], c])).astype(np.float32)
            bags[i] = (k.astype(np.int32), c)
    rng = np.random.default_rng(s.seed)
    vectors = rng.uniform(-1 / s.dim, 1 / s.dim, (size, s.dim)).astype(np.float32)
    output = rng.normal(0, 1, (s.dim, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    steps, done = s.epochs * len(texts), 0
    for _ in range(s.epochs):
        for i in rng.permutation(len(texts)):
            rate = s.rate * (1 - done / steps)
            done += 1
            k, c = bags[i]
            w = c / max(c.sum(), 1)
            mean = w @ vectors[k] if len(k) else np.zeros(s.dim, np.float32)
            logit = mean @ output + bias
            p = np.exp(logit - logit.max())
            slope = p / p.sum()
            slope[int(labels[i])] -= 1
            back = output @ slope
            output -= rate * np.outer(mean, slope)
            bias -= 0.1 * rate * slope
            if len(k):
                # Scaled so that the mean itself moves by the rate, however many features there are.
                vectors[k] -= rate * (w / (w @ w))[:, None] * back * 0.2
    weights = vectors @ (output[:, 1] - output[:, 0])
    return Model(s, weights.astype(np.float32), float(bias[1] - bias[0]))


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees: a fifth, by a hash of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, s: Settings) -> DataFrame:
    """A bounded, repeatable sample: the first labelled rows of each class by a hash of the id.

    Of an id with several texts, the shortest counts. A text that does not fit into what is left
    of its class's characters is passed over, and those after it still get their turn.
    """
    wanted = (
        labels.where(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(label).alias("label"))
    )
    order = F.xxhash64(F.lit(s.seed), "doc_id")
    half = [wanted.where(F.col("label") == y).orderBy(order, "doc_id").limit(s.max_docs // 2) for y in (0, 1)]
    few = half[0].unionByName(half[1])
    # At most max_docs rows, from here on. Sizes alone decide which texts are read.
    found = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")
    named = found.select("doc_id", "text", "label", F.coalesce(F.length("text"), F.lit(0)).alias("size"), F.xxhash64("text").alias("h"))
    sized = named.groupBy("doc_id", "label").agg(F.min(F.struct("size", "h")).alias("pick")).select("doc_id", "label", "pick.*")
    room, chosen = {0: s.max_chars // 2, 1: s.max_chars // 2}, []
    for r in sized.orderBy(order, "doc_id").collect():
        if r["size"] <= room[r["label"]]:
            room[r["label"]] -= r["size"]
            chosen.append(tuple(r))
    picked = docs.sparkSession.createDataFrame(chosen, sized.schema)
    return named.join(F.broadcast(picked), ["doc_id", "label", "size", "h"]).dropDuplicates(["doc_id"]).select("doc_id", "text", "label")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", settings: Settings = Settings()) -> Model:
    rows = sorted(training_rows(docs, labels, label, settings).collect(), key=lambda r: r.doc_id)
    return train([r.text for r in rows], np.array([r.label for r in rows], dtype=np.int64), settings)


def _scores(batch: pa.Array, model: Model) -> np.ndarray:
    parts = (batch.slice(i, _ROWS).to_pylist() for i in range(0, len(batch), _ROWS))
    odds = np.concatenate([np.zeros(0), *(log_odds(part, model) for part in parts)])
    return 1 / (1 + np.exp(-odds))


def score(text: Column, model: Model) -> Column:
    """Probability of label 1."""

    @F.arrow_udf("double")
    def apply(batch: pa.Array) -> pa.Array:
        return pa.array(_scores(batch, model))

    return apply(text)


def classify(docs: DataFrame, model: Model, cut: float = 0.3) -> DataFrame:
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def keep_good(docs: DataFrame, model: Model, cut: float = 0.3) -> DataFrame:
    """The rows that score at least `cut`, all columns as they were."""
    return docs.where(score(F.col("text"), model) >= cut)
