"""Ranked lexical search: the best documents of each item, by groups of equal term masks.

A document's score for an item is a sum over the item's terms of a weight and a part that grows
with the term's frequency and falls with the document's length. Nearly every document holds
some term of nearly every item, so that scoring them one by one is what costs.

1. Counts. One pass over the texts keeps, per document, its length and the frequencies of those
   terms that some item has. Their sums give the numbers of documents and terms and the
   documents of each term, over all documents.
2. Masks. A task takes its documents in blocks. A term is a bitmap over a block; the bitmaps of an
   item's terms, turned over, are one mask per document: the terms it holds. Documents with
   equal masks make up a group. A group's highest possible score takes each term's
   highest frequency in the block and the length of the group's shortest document.
3. Groups are scored from the highest possible score down. Once `k` documents are known, here or in
   an earlier block of the task, that are better than all a group can reach, no group
   that follows can matter. One with an equal highest score is still scored, as the id decides.
4. The best `k` of each task meet by item.

Only the items' terms go to the tasks. Items are taken in portions of at most `most_terms` terms,
which bounds what is sent however many items there are; documents never go to the driver.

Terms are compared by 64-bit hashes. Defined results: null and empty texts, and texts without
terms, are no documents for the counts and are never found; an item without terms finds nothing;
equal scores stand by id, a row without id first, and rows with one id in any order; rows of items
that repeat a whole row are one item, texts with one item_id are ranked each on its own; a text of
any length is read whole. Without documents or items the result is empty. Other columns are
not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from adgleaner.llm.common import written
from adgleaner.llm.tokens import byte_set, slices, text_bytes, word_hashes, word_places

# ASCII digits and letters, and all that is not ASCII.
_TERM = byte_set((48, 57), (65, 90), (97, 122), (128, 255))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SLICE = 1 << 22
# Documents in a block of bitmaps.
_BLOCK = 8192


def hashed_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of some texts in order, and the text of each."""
    data, offsets = text_bytes(texts)
    data = _LOWER[data]
    first, end, of = word_places(data, offsets, _TERM)
    return word_hashes(data, first, end), of


def _source(table: DataFrame, key: str) -> DataFrame:
    return table.select(F.col(key).cast("long").alias(key), F.coalesce(F.col("text"), F.lit("")).alias("text"))


ITEM = "item_id long, h long, terms array<long>"


def item_terms(items: DataFrame) -> DataFrame:
    """Per item its terms as hashes, repeats included, and `h`, a hash of its text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, of = hashed_terms(batch["text"])
            bounds = np.searchsorted(of, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(terms.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch["item_id"], batch["h"], lists], ["item_id", "h", "terms"])

    each = _source(items, "item_id").dropDuplicates().withColumn("h", F.xxhash64("text"))
    return each.mapInArrow(read, ITEM)


COUNTED = "doc_id long, n long, terms array<int>, freq array<int>"


def counted(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """Per document with a term: `n`, its terms with repeats, and the numbers and frequencies of those that are `known`."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                h, of = hashed_terms(part["text"])
                n = np.bincount(of, minlength=part.num_rows)
                at = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
                hit = known[at] == h if len(known) else np.zeros(len(h), bool)
                width = max(len(known), 1)
                key, freq = np.unique(of[hit] * width + at[hit], return_counts=True)
                bounds = pa.array(np.searchsorted(key, np.arange(part.num_rows + 1) * width).astype(np.int32))
                lists = [
                    pa.ListArray.from_arrays(bounds, pa.array(v.astype(np.int32))) for v in (key % width, freq)
                ]
                out = pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(n.astype(np.int64)), *lists], ["doc_id", "n", "terms", "freq"]
                )
                yield out.filter(pa.array(n > 0))

    return _source(docs, "doc_id").mapInArrow(read, COUNTED)


def part_of_score(weight: np.ndarray, freq: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * freq) // (1000 * freq + 12 * m))


class Block:
    """Some documents and, per term, a bitmap of those that hold it."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, terms: np.ndarray, freq: np.ndarray, row: np.ndarray, n_terms: int):
        self.ids, self.m = ids, m
        order = np.argsort(terms, kind="stable")
        self.row, self.freq = row[order], freq[order].astype(np.int64)
        self.bounds = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.bits: dict[int, np.ndarray] = {}

    def bitmap(self, term: int) -> np.ndarray:
        if term not in self.bits:
            holds = np.zeros(len(self.ids), bool)
            holds[self.row[self.bounds[term] : self.bounds[term + 1]]] = True
            self.bits[term] = np.packbits(holds)
        return self.bits[term]

    def masks(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct masks as rows of a boolean table, and the mask of each document."""
        maps = np.stack([self.bitmap(t) for t in terms])
        group = np.zeros(len(self.ids), np.int64)
        for at in range(0, len(terms), 32):
            word = np.zeros(len(self.ids), np.int64)
            for k, row in enumerate(maps[at : at + 32]):
                word |= np.unpackbits(row, count=len(self.ids)).astype(np.int64) << k
            group = np.unique(word + (group << 32), return_inverse=True)[1]
        first = np.unique(group, return_index=True)[1]
        held = maps[:, first >> 3] >> (7 - (first & 7)).astype(np.uint8) & 1
        return held.T.astype(bool), group

    def scores(self, rows: np.ndarray, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact scores of some documents; `rows` are in order."""
        out = np.zeros(len(rows), np.int64)
        for t, w in zip(terms, weight):
            a, b = self.bounds[t], self.bounds[t + 1]
            if a == b:
                continue
            at = np.minimum(np.searchsorted(self.row[a:b], rows), b - a - 1) + a
            hit = self.row[at] == rows
            out[hit] += part_of_score(w, self.freq[at[hit]], self.m[rows[hit]])
        return out

    def best(self, terms: np.ndarray, weight: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows and scores of all documents that may be among the `k` best, none of them below `least`; and how many were scored."""
        held, group = self.masks(terms)
        size = np.bincount(group)
        shortest = np.full(len(size), np.iinfo(np.int64).max)
        np.minimum.at(shortest, group, self.m)
        highest = np.zeros(len(size), np.int64)
        for i, (t, w) in enumerate(zip(terms, weight)):
            f = self.freq[self.bounds[t] : self.bounds[t + 1]].max(initial=0)
            highest[held[:, i]] += part_of_score(w, f, shortest[held[:, i]])
        order = np.argsort(-highest, kind="stable")
        in_order = np.argsort(group, kind="stable")
        begin = np.concatenate([[0], np.cumsum(size)])
        rows, got, done, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, k
        least = max(least, 1)
        while done < len(order) and highest[order[done]] >= least:
            # The groups that follow, as long as they can matter and hold about so many documents.
            room = np.searchsorted(np.cumsum(size[order[done:]]), step) + 1
            take = order[done : done + room]
            take = take[highest[take] >= least]
            done += room
            new = np.sort(np.concatenate([in_order[begin[g] : begin[g + 1]] for g in take]))
            rows, got = np.concatenate([rows, new]), np.concatenate([got, self.scores(new, terms, weight)])
            if len(got) >= k:
                least = max(least, int(np.partition(got, len(got) - k)[len(got) - k]))
            step *= 4
        scored = len(rows)
        keep = got >= least
        return rows[keep], got[keep], scored


FOUND = "item int, doc_id long, score long"


def _top(items: list[tuple[np.ndarray, np.ndarray]], n_terms: int, documents: int, all_terms: int, k: int):
    """Per task, the best documents of each item."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in items]
        for batch in batches:
            for at in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(at, _BLOCK)
                lists = part["terms"]
                row = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
                known = part["doc_id"].is_valid().to_numpy(zero_copy_only=False)
                ids = part["doc_id"].fill_null(0).to_numpy()
                # In Python's integers where 64 bits could overflow before the division.
                n = part["n"].to_numpy()
                if int(n.max()) * 25 * documents >= 1 << 62:
                    m = np.array([75 + 25 * int(x) * documents // all_terms for x in n], np.int64)
                else:
                    m = 75 + 25 * n * documents // all_terms
                block = Block(ids, m, lists.flatten().to_numpy(), part["freq"].flatten().to_numpy(), row, n_terms)
                for i, (terms, weight) in enumerate(items):
                    if len(terms):
                        least = int(best[i][1].min()) if len(best[i][1]) >= k else 0
                        rows, got, _ = block.best(terms, weight, k, least)
                        if len(rows):
                            joint = [np.concatenate(p) for p in zip(best[i], (ids[rows], got, known[rows]))]
                            order = np.lexsort((joint[0], joint[2], -joint[1]))[:k]
                            best[i] = tuple(x[order] for x in joint)
        size = [len(b[0]) for b in best]
        if sum(size):
            ids, got, known = (np.concatenate(p) for p in zip(*best))
            item = np.repeat(np.arange(len(items)), size).astype(np.int32)
            columns = [pa.array(item), pa.array(ids, mask=~known), pa.array(got)]
            yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return search


def _portions(rows: list, most_terms: int) -> Iterator[list]:
    part, terms = [], 0
    for r in rows:
        if part and terms + len(r.terms) > most_terms:
            yield part
            part, terms = [], 0
        part.append(r)
        terms += len(r.terms)
    if part:
        yield part


def search(docs: DataFrame, items: DataFrame, k: int = 20, most_terms: int = 1_000_000) -> DataFrame:
    """Per item its `k` best documents with a score above 0: `item_id, rank, doc_id, score`."""
    spark = docs.sparkSession
    asked = written(item_terms(items), "search-items")
    results = []
    for portion in _portions(asked.orderBy("item_id", "h").toLocalIterator(), most_terms):
        known = np.unique(np.array([t for r in portion for t in r.terms], np.int64).view(np.uint64))
        table = written(counted(docs, known), "search-counts")
        whole = table.agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).first()
        df = np.zeros(len(known), np.int64)
        for r in table.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
            df[r.t] = r["count"]
        n = whole.documents
        weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        numbered = []
        for r in portion:
            numbers = np.searchsorted(known, np.array(r.terms, np.int64).view(np.uint64))
            terms, often = np.unique(numbers, return_counts=True)
            held = df[terms] > 0
            numbered.append((terms[held], weights[terms[held]] * often[held]))
        best = table.mapInArrow(_top(numbered, len(known), n, whole.terms or 1, k), FOUND)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(portion)], "item int, item_id long")
        results.append(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = results[0]
    for r in results[1:]:
        out = out.union(r)
    return out
