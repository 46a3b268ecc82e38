"""The charset of bytes that name none, by how likely their byte pairs are in each.

`learn` counts the byte pairs that given texts make in every charset; a page is then taken for
the charset in which its own pairs are likeliest. Only pairs with a byte above 127 count: all
others look the same in every charset of one byte a letter.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

# Executors need no copy of this module: the helper travels with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHARSETS = ("windows-1252", "ibm850", "macintosh", "windows-1251", "koi8-r", "ibm866", "iso-8859-5", "iso-8859-7")
_PAIRS = 1 << 16


def _pairs(b: bytes) -> np.ndarray:
    a = np.frombuffer(b, np.uint8).astype(np.int64)
    return (a[:-1] * 256 + a[1:])[(a[:-1] | a[1:]) > 127]


@dataclass(frozen=True)
class CharsetModel:
    """Log-likelihood of each byte pair in each charset."""

    charsets: tuple[str, ...]
    weights: np.ndarray

    def best(self, b: bytes) -> str:
        """Likeliest charset in which the bytes are valid; of equals the first. The likeliest if none is."""
        pair, count = np.unique(_pairs(b), return_counts=True)
        order = np.argsort(-(self.weights[:, pair] @ count), kind="stable")
        for i in order:
            try:
                b.decode(self.charsets[i])
            except UnicodeDecodeError:
                continue
            return self.charsets[i]
        return self.charsets[order[0]]

    def detect(self, b: Column) -> Column:
        """Name of the charset of some bytes; NULL for NULL."""

        @F.arrow_udf("string")
        def apply(batch: pa.Array) -> pa.Array:
            return pa.array([None if x is None else self.best(x) for x in batch.to_pylist()], pa.string())

        return apply(b)


def learn(texts: DataFrame, text: str = "text", charsets: tuple[str, ...] = CHARSETS, smoothing: float = 0.01) -> CharsetModel:
    """Count byte pairs of all texts in every charset.

    A letter that a charset lacks becomes a question mark there. Tasks send sums, and at most
    65,536 numbers a charset reach the driver, whatever the texts are.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(charsets), _PAIRS), np.int64)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                for i, c in enumerate(charsets) if t else ():
                    pair, n = np.unique(_pairs(t.encode(c, "replace")), return_counts=True)
                    total[i, pair] += n
        i, pair = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(pair), pa.array(total[i, pair])], ["i", "pair", "n"])

    counted = texts.select(text).mapInArrow(count, "i bigint, pair bigint, n bigint")
    counts = np.full((len(charsets), _PAIRS), smoothing)
    for r in counted.groupBy("i", "pair").agg(F.sum("n").alias("n")).collect():
        counts[r.i, r.pair] += r.n
    return CharsetModel(tuple(charsets), np.log(counts / counts.sum(1, keepdims=True)))
