"""Remove long passages of words that an earlier document has, by prefix-partitioned suffix trees.

A window is `length` words in a row. What a document may lose are the words of windows that
also start in a document with a smaller id. In a suffix tree of all texts the windows that are
alike hang below one node of depth `length`, so that the least id among its leaves decides.
One tree of a corpus fits nowhere; it falls into subtrees by the prefixes of its suffixes:

1. Prefixes. Of the 16-word strings in a window the one with the least hash is its anchor. A
   window is filed below the prefix that ends with its anchor, 16 to `length` words long, so
   that windows that are alike have equal prefixes. Neighbouring windows with one anchor
   overlap; they travel as one context of at most 2 * length - 16 words, and the prefixes of
   one anchor stay together.
2. Prefixes of one document only have no inner node in their subtree. They go first, by a
   least and a largest id per anchor, before any text moves. Equal contexts are one leaf
   with the least and the largest id of their documents.
3. Anchors are gathered into groups that fit into memory. Of a group's suffixes the order and
   the branching depths are found by doubling, on words that are compared as such. Runs of
   leaves that branch at `length` words or deeper are its deep inner nodes; each node's least
   id goes to all its leaves. Neighbouring windows of a node make up a maximal repeat.
4. An anchor with more than `most_contexts` different contexts does not fit: the prefixes of
   its windows are lengthened to the whole window, below which there is one node. That is an
   aggregate over hashes of windows, partial before it is shuffled.

The same windows are found either way. Anchors, and contexts or windows that have equal
anchors, are told apart by 64-bit hashes; words in a subtree are compared byte by byte.

Defined results: null and empty texts, and texts with fewer words than `length`, lose nothing;
neither does a row without id, which is also no one's smaller document. Rows with one id do not
count as repeats of each other; rows that repeat a whole row give equal results. Equal windows
of one document alone stay. A text of any length is cut into pieces that share all but one word of
a window. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adgleaner.llm.common import words, written
from adgleaner.llm.tokens import BLANK, U, joined, mix, slices, text_bytes, word_hashes, word_places
from adgleaner.operators.skew import left_join_spread

_GRAM = 16
# Bytes of texts handled at a time; a place in them must fit 24 bits.
_SLICE = 1 << 22
# Words of a text handled at a time.
_PIECE = 1 << 18
# Bytes of contexts in one group of subtrees.
_GROUP = 1 << 22

CONTEXT = "anchor long, context long, doc_id long, h int, first long, windows int, at long, size int"


def _source(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.hash(text).alias("h"), text.alias("text"))


def _runs(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row of each run of rows that have equal values in all columns."""
    n = len(columns[0])
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(n, bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    first = np.flatnonzero(new)
    return first, np.concatenate([first[1:], [n]]) - 1


def anchored(hashes: np.ndarray, text: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Contexts of some words: hash of the anchor, hash of the context, first window and number of windows."""
    n = len(hashes) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    grams = [hashes]
    with np.errstate(over="ignore"):
        while len(grams) < 6:  # of 1, 2, 4, 8, 16 and 32 words; past the end they hold what comes around
            g = grams[-1]
            grams.append(joined(g, np.roll(g, -(1 << len(grams) - 1))))
        # The least hash of a window, the leftmost of equals: hash above, place below.
        least = mix(grams[4]) >> U(24) << U(24) | np.arange(len(hashes), dtype=np.uint64)
        span, width = 1, length - _GRAM + 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[: n], least[width - span : width - span + n])
        owner = (least & U(0xFFFFFF)).astype(np.int64)
        inside = np.flatnonzero(text[:n] == text[length - 1 :])
        first, last = _runs(owner[inside], text[inside])
        # Windows that a short text parts are not neighbours, but such a text ends the run.
        start, stop = inside[first], inside[last] + length
        h = U(length) + (stop - start).astype(np.uint64)
        for at in range(0, 2 * length - _GRAM, 32):
            h = joined(h, grams[5][np.minimum(start + at, stop - 32)])
    return grams[4][owner[start]], h, start, stop - start - length + 1


def contexts(docs: DataFrame, length: int) -> DataFrame:
    """One row per context of every text: `first` counts words, `at` and `size` bytes."""
    if length < 32:
        raise ValueError("windows must have at least 32 words")
    names = [c.split()[0] for c in CONTEXT.split(", ")]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                data, offsets = text_bytes(part["text"])
                begin, end, text = word_places(data, offsets, ~BLANK)
                hashes = word_hashes(data, begin, end)
                # Number of the first word of each text.
                zero = np.searchsorted(text, np.arange(part.num_rows))
                for p in range(0, max(len(hashes) - length + 1, 0), _PIECE):
                    q = p + _PIECE + length - 1
                    anchor, context, start, windows = anchored(hashes[p:q], text[p:q], length)
                    if not len(start):
                        continue
                    start = start + p
                    of = text[start]
                    at = begin[start]
                    size = end[start + windows + length - 2] - at
                    columns = [
                        pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)),
                        part["doc_id"].take(pa.array(of)), part["h"].take(pa.array(of)),
                        pa.array(start - zero[of]), pa.array(windows.astype(np.int32)),
                        pa.array(at - offsets[of]), pa.array(size.astype(np.int32)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return _source(docs).where("doc_id IS NOT NULL").mapInArrow(find, CONTEXT)


def subtree(ids: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaves of the suffix tree of some words, in order, and the depth at which each branches from the one before.

    `starts` are the suffixes; all have `depth` words at least, and what is deeper is not told apart.
    """
    # Rank of each string of 1, 2, 4 ... words, by the ranks of its halves.
    ranks, width = [(1, ids.astype(np.int64))], 1
    while width * 2 <= depth:
        r = ranks[-1][1]
        key = r[:-width] * (int(r.max(initial=0)) + 1) + r[width:]
        width *= 2
        ranks.append((width, np.unique(key, return_inverse=True)[1]))
    r = ranks[-1][1]
    high, low = r[starts], r[starts + depth - width]
    order = np.lexsort((low, high))
    leaves = starts[order]
    branch = np.zeros(len(leaves), np.int64)
    i, j, left = leaves[:-1].copy(), leaves[1:].copy(), np.full(max(len(leaves) - 1, 0), depth)
    for width, r in reversed(ranks):
        again = True
        while again:  # the widest strings may be met twice
            ok = np.flatnonzero(left >= width)
            ok = ok[r[i[ok]] == r[j[ok]]]
            i[ok] += width
            j[ok] += width
            left[ok] -= width
            again = width == ranks[-1][0] and bool(len(ok)) and bool((left[ok] >= width).any())
    branch[1:] = depth - left
    return leaves, branch


def deep_nodes(data: list[bytes], least: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Per window of some contexts: the context, the number of the window, and the least id below its node."""
    bytes_, offsets = text_bytes(pa.array(data, pa.binary()))
    begin, end, of = word_places(bytes_, offsets, ~BLANK)
    packed = bytes_[~BLANK[bytes_]]
    bounds = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64)
    each = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(bounds), pa.py_buffer(packed)])
    ids = each.dictionary_encode().indices.to_numpy()
    n = len(ids) - length + 1
    starts = np.flatnonzero(of[:n] == of[length - 1 :])
    leaves, branch = subtree(ids, starts, length)
    node = np.flatnonzero(branch < length)
    owner = np.minimum.reduceat(least[of[leaves]], node) if len(node) else np.zeros(0, np.int64)
    sizes = np.diff(np.concatenate([node, [len(leaves)]]))
    out = np.zeros(len(ids), np.int64)
    out[leaves] = np.repeat(owner, sizes)
    zero = np.searchsorted(of, np.arange(len(data)))
    return of[starts], starts - zero[of[starts]], out[starts]


_LIST = "array<struct<first: int, windows: int, owner: bigint>>"
REPEATS = f"anchor long, context long, repeats {_LIST}"


def _of_groups(rows: DataFrame, length: int) -> DataFrame:
    """`REPEATS` of contexts whose subtrees fit into memory, group by group."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for r in zip(*(batch[c].to_pylist() for c in ("anchor", "context", "lo", "hi", "data"))):
                if size > _GROUP and r[0] != held[-1][0]:
                    yield grow(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[4])
        if held:
            yield grow(held)

    def grow(held: list[tuple]) -> pa.RecordBatch:
        anchor, context, lo, hi, data = zip(*held)
        of, window, owner = deep_nodes(list(data), np.array(lo, np.int64), length)
        # A maximal repeat: neighbouring windows of one context with one least id, of use to documents with larger ids.
        first, last = _runs(of, owner)
        use = owner[first] < np.array(hi, np.int64)[of[first]]
        first, last = first[use], last[use]
        parts = pa.StructArray.from_arrays(
            [
                pa.array(window[first].astype(np.int32)),
                pa.array((last - first + 1).astype(np.int32)),
                pa.array(owner[first]),
            ],
            ["first", "windows", "owner"],
        )
        bounds = np.searchsorted(of[first], np.arange(len(held) + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(bounds), parts)
        some = pa.array(np.diff(bounds) > 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor, pa.int64()), pa.array(context, pa.int64()), lists], ["anchor", "context", "repeats"]
        ).filter(some)

    near = rows.repartition("anchor").sortWithinPartitions("anchor", "context")
    return near.select("anchor", "context", "lo", "hi", "data").mapInArrow(search, REPEATS)


def _of_windows(rows: DataFrame, length: int) -> DataFrame:
    """The same for anchors with too many contexts: prefixes as long as the window."""

    def lengthen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "data", _SLICE):
                data, offsets = text_bytes(part["data"])
                begin, end, of = word_places(data, offsets, ~BLANK)
                h = word_hashes(data, begin, end)
                n = len(h) - length + 1
                starts = np.flatnonzero(of[: max(n, 0)] == of[length - 1 :])
                with np.errstate(over="ignore"):
                    key = np.full(len(starts), length, np.uint64)
                    for k in range(length):
                        key = joined(key, h[starts + k])
                of_start = of[starts]
                zero = np.searchsorted(of, np.arange(part.num_rows))
                take = pa.array(of_start)
                columns = [part[c].take(take) for c in ("anchor", "context", "lo", "hi")]
                columns += [pa.array((starts - zero[of_start]).astype(np.int32)), pa.array(key.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "context", "lo", "hi", "first", "key"])

    kind = "anchor long, context long, lo long, hi long, first int, key long"
    each = written(rows.select("anchor", "context", "lo", "hi", "data").mapInArrow(lengthen, kind), "tree-windows")
    each = each.select("context", "lo", "hi", "first", F.struct("anchor", "key").alias("prefix"))
    nodes = each.groupBy("prefix").agg(F.min("lo").alias("owner"), F.count("*").alias("leaves"))
    placed = left_join_spread(each, nodes, "prefix", "leaves", "context").where("owner < hi")
    one = F.struct("first", F.lit(1).alias("windows"), "owner")
    per = placed.groupBy(F.col("prefix.anchor").alias("anchor"), "context").agg(F.collect_list(one).alias("repeats"))
    return per.select("anchor", "context", F.col("repeats").cast(_LIST))


def repeats(docs: DataFrame, length: int = 50, most_contexts: int = 2000) -> DataFrame:
    """`doc_id, h, first, words, owner`: passages of `words` words from word `first` on, all of whose windows
    start in the document `owner` too, which has a smaller id."""
    found = written(contexts(docs, length), "tree-contexts")
    # The least and the largest document of an anchor: most anchors have but one.
    shared = found.groupBy("anchor").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("rows")
    ).where("lo < hi")
    # An anchor of very many documents is joined in place.
    marked = left_join_spread(found, shared.select("anchor", "rows", F.lit(True).alias("shared")), "anchor", "rows", "doc_id")
    some = written(marked.where("shared").drop("shared"), "tree-shared")
    place = [F.first(c).alias(c) for c in ("doc_id", "h", "at", "size")]
    leaves = written(
        some.groupBy("anchor", "context").agg(
            F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("rows"), *place
        ),
        "tree-leaves",
    )
    busy = leaves.groupBy("anchor").count().where(F.col("count") > most_contexts).select("anchor")
    busy = written(busy, "tree-busy")
    wanted = leaves.groupBy("doc_id", "h").agg(
        F.collect_list(F.struct("anchor", "context", "lo", "hi", "at", "size")).alias("wanted")
    )
    text = _source(docs).join(wanted, ["doc_id", "h"]).dropDuplicates(["doc_id", "h"])
    each = text.select(F.col("text").cast("binary").alias("bytes"), F.explode("wanted").alias("x"))
    piece = F.substring("bytes", (F.col("x.at") + 1).cast("int"), F.col("x.size"))
    whole = written(each.select("x.anchor", "x.context", "x.lo", "x.hi", piece.alias("data")), "tree-text")
    if busy.isEmpty():
        nodes = _of_groups(whole, length)
    else:
        nodes = _of_groups(whole.join(busy, "anchor", "left_anti"), length)
        nodes = nodes.union(_of_windows(whole.join(busy, "anchor", "left_semi"), length))
    nodes = written(nodes, "tree-nodes")
    # Back to all places of a context; one that has very many is joined in place.
    weight = leaves.select("anchor", "context", "rows")
    right = nodes.join(weight, ["anchor", "context"]).select(
        F.struct("anchor", "context").alias("leaf"), "repeats", "rows"
    )
    left = some.select(F.struct("anchor", "context").alias("leaf"), "doc_id", "h", F.col("first").alias("begin"))
    met = left_join_spread(left, right, "leaf", "rows", "doc_id").where("repeats IS NOT NULL")
    one = met.select("doc_id", "h", "begin", F.inline("repeats")).where("owner < doc_id")
    span = (F.col("windows") + (length - 1)).cast("long")
    return one.select("doc_id", "h", (F.col("begin") + F.col("first")).alias("first"), span.alias("words"), "owner")


def removed(docs: DataFrame, length: int = 50, **options) -> DataFrame:
    """Per row: `doc_id, n_words, n_removed, kept`; `kept` joins the words that stay by one space."""
    passages = written(repeats(docs, length, **options), "tree-passages")
    per = passages.groupBy("doc_id", "h").agg(F.collect_set(F.struct("first", "words")).alias("passages"))

    @F.arrow_udf("struct<n_words: bigint, n_removed: bigint, kept: binary>")
    def cut(text: pa.Array, passages: pa.Array) -> pa.Array:
        out = []
        for t, p in zip(text, passages):
            if not p.is_valid:
                out.append(None)
                continue
            data = np.frombuffer(t.as_buffer(), np.uint8)
            begin, end, _ = word_places(data, np.array([0, len(data)]), ~BLANK)
            runs = p.values.flatten()
            depth = np.zeros(len(begin) + 1, np.int64)
            np.add.at(depth, runs[0].to_numpy(), 1)
            np.add.at(depth, runs[0].to_numpy() + runs[1].to_numpy(), -1)
            gone = np.cumsum(depth[:-1]) > 0
            kept = b" ".join(data[a:b].tobytes() for a, b in zip(begin[~gone], end[~gone]))
            out.append({"n_words": len(begin), "n_removed": int(gone.sum()), "kept": kept})
        kind = [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())]
        return pa.array(out, pa.struct(kind))

    s, p = _source(docs).alias("s"), per.alias("p")
    both = s.join(p, (F.col("s.doc_id") == F.col("p.doc_id")) & (F.col("s.h") == F.col("p.h")), "left")
    # Only texts that lose something leave the JVM.
    some = F.when(F.col("passages").isNotNull(), F.col("text"))
    done = both.select("s.doc_id", "text", cut(some, F.col("passages")).alias("c"))
    done = done.select("doc_id", "c", F.when(F.col("c").isNull(), words(F.col("text"))).alias("all"))
    return done.select(
        "doc_id",
        F.coalesce("c.n_words", F.size("all").cast("long")).alias("n_words"),
        F.coalesce("c.n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce(F.col("c.kept").cast("string"), F.array_join("all", " ")).alias("kept"),
    )
