"""Remove long strings that occur more than once, by a run-compressed suffix index.

Every byte covered by a string of `length` bytes that also starts elsewhere goes.
An index over a whole corpus cannot be cut into tasks, but repeats can be brought
together first, without losing one:

1. Anchors. Of the 32-byte strings in each window of `length` bytes the one with
   the least hash is the window's anchor. Equal windows have equal anchors at
   equal places. The neighbouring windows of one anchor make up its context; each
   window lies in exactly one context.
2. Contexts meet by anchor, in one sorted pass. Equal contexts are repeats as a
   whole. An anchor with one context needs no index. What is left are anchors
   with several different contexts: the ends of copied passages.
3. These are indexed in blocks of whole anchors: suffix order, Burrows-Wheeler
   transform, its runs, and the longest common prefix with the neighbouring row
   at the two ends of each run only. Within a run the value falls by one per
   byte, so that matching statistics stream over the text from these samples.
   Where they reach `length`, a window starts elsewhere too.
4. An anchor with more than `most_contexts` different contexts does not go to one
   task: its windows meet by their own hash instead, counted where they are.

Anchors, and the contexts and windows of one anchor, are compared by 64-bit
hashes; strings in the index are compared byte by byte.

Defined results: null and empty texts have no bytes; a text shorter than
`length` loses nothing; a row that repeats another is a copy of it; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adgleaner.llm.common import written

_U = np.uint64
_ANCHOR = 32
_BASE = _U(0x100000001B3)
_BASE_INV = _U(pow(0x100000001B3, -1, 1 << 64))
# Bytes handled at a time when anchors are found; one position must fit 24 bits.
_CHUNK = 1 << 20
# Bytes of contexts that make one index.
_BLOCK = 1 << 21


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]))


class Anchors:
    """Finds anchors and contexts in bytes."""

    def __init__(self, length: int):
        if length <= _ANCHOR:
            raise ValueError(f"strings must be longer than {_ANCHOR} bytes")
        self.length, self.grams = length, length - _ANCHOR + 1
        with np.errstate(over="ignore"):
            self.values = _mix(np.arange(1, 257, dtype=np.uint64))
            n = 2 * _CHUNK + 2 * length
            self.powers, self.inverse = _powers(n, _BASE), _powers(n, _BASE_INV)

    def of(self, a: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per context: anchor hash, context hash, document number, start and size in `a`."""
        n = len(a) - self.length + 1
        if n <= 0:
            return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
        v = self.values[a]
        h, step, power = v, 1, _BASE
        while step < _ANCHOR:
            h = h[:-step] * power + h[step:]
            power, step = power * power, step * 2
        h = _mix(h)
        m = (h >> _U(24) << _U(24)) | np.arange(len(h), dtype=np.uint64)
        span = 1
        while span * 2 <= self.grams:
            m = np.minimum(m[:-span], m[span:])
            span *= 2
        if self.grams > span:
            m = np.minimum(m[: len(m) - (self.grams - span)], m[self.grams - span :])
        owner = (m & _U(0xFFFFFF)).astype(np.int64)
        inside = np.flatnonzero(doc[:n] == doc[self.length - 1 :])
        if not len(inside):
            return self.of(a[:0], doc[:0])
        at, d = owner[inside], doc[inside]
        cut = np.flatnonzero((at[1:] != at[:-1]) | (d[1:] != d[:-1])) + 1
        first = np.concatenate([[0], cut])
        last = np.concatenate([cut, [len(at)]]) - 1
        start, end = inside[first], inside[last] + self.length
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(v * self.powers[: len(a)])])
        context = _mix((total[end] - total[start]) * self.inverse[start] + (end - start).astype(np.uint64))
        return h[at[first]], context, d[first], start, end - start


ANCHORS = "anchor long, context long, doc_id long, h int, start long, size long, many boolean, goes boolean"


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """One row per context of every text.

    Of equal contexts that a task meets together, `many`, only one `goes` on to meet
    the others: what a common line repeats does not flood the task of its anchor.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(length)

        def flush(parts: list[tuple]) -> pa.RecordBatch:
            a = np.concatenate([p[0] for p in parts])
            doc = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
            anchor, context, of, start, size = finder.of(a, doc)
            first = np.cumsum([0, *(len(p[0]) for p in parts)])[:-1]
            # From a place among the parts to a place in the text.
            shift = np.array([p[3] for p in parts]) - first
            ids = pa.array([p[1] for p in parts], pa.int64()).take(pa.array(of))
            hs = pa.array([p[2] for p in parts], pa.int32()).take(pa.array(of))
            _, goes, group, count = np.unique(anchor ^ _mix(context), return_index=True, return_inverse=True, return_counts=True)
            one = np.zeros(len(anchor), bool)
            one[goes] = True
            columns = (anchor.view(np.int64), context.view(np.int64), ids, hs, start + shift[of], size, count[group] > 1, one)
            return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

        names = [c.split()[0] for c in ANCHORS.split(", ")]
        with np.errstate(over="ignore"):
            parts, held = [], 0
            for batch in batches:
                for doc_id, h, text in zip(*(batch.column(i) for i in range(3))):
                    data = np.frombuffer(text.as_buffer() or b"", np.uint8)
                    # A long text goes in pieces that share all but one byte of a window.
                    for at in range(0, max(len(data) - length + 1, 0), _CHUNK):
                        piece = data[at : at + _CHUNK + length - 1]
                        if parts and held + len(piece) > _CHUNK:
                            yield flush(parts)
                            parts, held = [], 0
                        parts.append((piece, doc_id.as_py(), h.as_py(), at))
                        held += len(piece)
            if parts:
                yield flush(parts)

    return _source(docs).mapInArrow(find, ANCHORS)


def _source(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.hash(text).alias("h"), text.alias("text"))


def met(found: DataFrame) -> DataFrame:
    """Contexts whose anchor has another row: `whole` if an equal context does, `differs` if one that is not equal does.

    `first` marks one row per context. A sorted pass that holds the rows of one
    batch and one context at a time, however often an anchor occurs.
    """

    def passes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # the first two rows of the last context, which say all there is to know of it
        before = False  # its anchor had another context before it
        for batch in batches:
            if batch.num_rows:
                t = pa.Table.from_batches([batch])
                out, held, before = judge(t if held is None else pa.concat_tables([held, t]), before, False)
                yield from out
        if held is not None:
            yield from judge(held, before, True)[0]

    def judge(t: pa.Table, before: bool, end: bool) -> tuple[list[pa.RecordBatch], pa.Table, bool]:
        a, c = t["anchor"].to_numpy(), t["context"].to_numpy()
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
        run, start = np.cumsum(new) - 1, np.flatnonzero(new)
        same = a[start[1:]] == a[start[:-1]]
        differs = np.concatenate([[before], same]) | np.concatenate([same, [False]])
        whole = (np.bincount(run) > 1) | (np.bincount(run, weights=t["many"].to_numpy()) > 0)
        out = (whole | differs)[run]
        if not end:
            out[start[-1] : start[-1] + 2] = False
        keep = np.flatnonzero(out)
        done = t.take(pa.array(keep))
        for name, values in (("whole", whole[run]), ("differs", differs[run]), ("first", new)):
            done = done.append_column(name, pa.array(values[keep]))
        return done.to_batches(), t.slice(start[-1], 2), bool(same[-1]) if len(same) else before

    kind = ANCHORS + ", whole boolean, differs boolean, first boolean"
    return found.repartition("anchor").sortWithinPartitions("anchor", "context").mapInArrow(passes, kind)


def run_ends(sa: np.ndarray, bwt: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that begin a run of the transform, and rows that end one. Rows of context starts are runs of their own."""
    change = bwt[1:] != bwt[:-1]
    alone = starts[sa]
    head = np.concatenate([[True], change]) | alone
    head[1:] |= alone[:-1]
    tail = np.concatenate([head[1:], [True]])
    return np.flatnonzero(head), np.flatnonzero(tail)


def matching_statistics(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each place in some contexts, the length of the longest string from there that starts elsewhere in them too.

    Built as a run-length index: order of suffixes, transform, runs, prefixes
    shared at the ends of runs, and a pass over the text in between.
    """
    n = len(data)
    number = np.repeat(np.arange(len(sizes)), sizes)
    end = np.cumsum(sizes)[number]
    place = np.arange(n)
    # Order by seven bytes at once, then by twice as many each time. Beyond its end a context is all zeros.
    key = np.zeros(n, np.int64)
    for k in range(7):
        value = np.zeros(n, np.int64)
        fits = place + k < end
        value[fits] = data[place[fits] + k].astype(np.int64) + 1
        key = key << 9 | value
    depth, levels = 7, []
    while True:
        order = np.argsort(key)
        ordered = key[order]
        fresh = np.concatenate([[False], ordered[1:] != ordered[:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh) + 1
        levels.append((depth, rank.astype(np.int32)))
        if depth >= sizes.max():
            break
        later = np.zeros(n, np.int64)
        fits = place + depth < end
        later[fits] = rank[place[fits] + depth]
        key = rank * (n + 2) + later
        depth *= 2
    # Equal suffixes stand in the order of their contexts.
    sa = np.argsort(rank * (len(sizes) + 1) + number)
    starts = np.zeros(n, bool)
    starts[np.cumsum(sizes) - sizes] = True
    bwt = np.where(starts[sa], 0, data[np.maximum(sa - 1, 0)].astype(np.int16) + 1)
    heads, tails = run_ends(sa, bwt, starts)

    def shared(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix, by the ranks of all depths and then by bytes."""
        out = np.zeros(len(i), np.int64)
        i, j = i.copy(), j.copy()
        end_i, end_j = end[i], end[j]
        for deep, rank in reversed(levels):
            equal = (i < end_i) & (j < end_j)
            equal[equal] = rank[i[equal]] == rank[j[equal]]
            # A prefix that runs over the end counts up to it.
            step = np.where(equal, np.minimum(deep, np.minimum(end_i - i, end_j - j)), 0)
            i, j, out = i + step, j + step, out + step
        for _ in range(7):
            equal = (i < end_i) & (j < end_j)
            equal[equal] = data[i[equal]] == data[j[equal]]
            i, j, out = i + equal, j + equal, out + equal
        return out

    def streamed(rows: np.ndarray, other: int) -> np.ndarray:
        """Samples at some rows against the row `other` away, carried on through the text."""
        neighbour = rows + other
        real = (neighbour >= 0) & (neighbour < n)
        sample = np.zeros(n, np.int64)
        sample[sa[rows[real]]] = shared(sa[rows[real]], sa[neighbour[real]])
        last = np.zeros(n, np.int64)
        last[sa[rows]] = sa[rows]
        last = np.maximum.accumulate(last)
        return sample[last] - (place - last)

    return np.maximum(np.maximum(streamed(heads, -1), streamed(tails, 1)), 0)


def context_marks(contexts: DataFrame, length: int) -> DataFrame:
    """Marks within contexts of anchors that have several: `doc_id, h, start, size`.

    Anchors are gathered into blocks of about two MB; each block is one index.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        held = 0
        for batch in batches:
            for r in batch.to_pylist():
                if held > _BLOCK and r["anchor"] != rows[-1]["anchor"]:
                    yield block(rows)
                    rows, held = [], 0
                rows.append(r)
                held += len(r["data"])
        if rows:
            yield block(rows)

    def block(rows: list[dict]) -> pa.RecordBatch:
        sizes = np.array([len(r["data"]) for r in rows])
        data = np.frombuffer(b"".join(r["data"] for r in rows), np.uint8)
        hit = np.flatnonzero(matching_statistics(data, sizes) >= length)
        of = np.searchsorted(np.cumsum(sizes), hit, side="right")
        out = []
        if len(hit):
            cut = np.flatnonzero((hit[1:] != hit[:-1] + 1) | (of[1:] != of[:-1])) + 1
            first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(hit)]]) - 1
            begins = np.cumsum(sizes) - sizes
            for i, j in zip(first, last):
                r = rows[of[i]]
                out.append((r["doc_id"], r["h"], r["start"] + int(hit[i] - begins[of[i]]), int(hit[j] - hit[i]) + length))
        columns = list(zip(*out)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "h", "start", "size"])

    near = contexts.repartition("anchor").sortWithinPartitions("anchor")
    return near.mapInArrow(search, "doc_id long, h int, start long, size long")


def window_marks(contexts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with too many contexts for one index: windows meet by their hash."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            values = _mix(np.arange(1, 257, dtype=np.uint64))
            for batch in batches:
                for r in batch.to_pylist():
                    a = np.frombuffer(r["data"], np.uint8)
                    powers, inverse = _powers(len(a), _BASE), _powers(len(a), _BASE_INV)
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[a] * powers)])
                    n = len(a) - length + 1
                    key = _mix((total[length:] - total[:n]) * inverse[:n])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key.view(np.int64)),
                            pa.array([r["anchor"]] * n, pa.int64()),
                            pa.array([r["doc_id"]] * n, pa.int64()),
                            pa.array([r["h"]] * n, pa.int32()),
                            pa.array(np.arange(n) + r["start"]),
                        ],
                        ["key", "anchor", "doc_id", "h", "start"],
                    )

    each = written(contexts.mapInArrow(windows, "key long, anchor long, doc_id long, h int, start long"), "suffix-windows")
    twice = each.groupBy("key", "anchor").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return each.join(twice, ["key", "anchor"]).select("doc_id", "h", "start", F.lit(length).cast("long").alias("size"))


def marks(docs: DataFrame, length: int = 200, most_contexts: int = 5000) -> DataFrame:
    """`doc_id, h, start, size`: pieces of texts, in bytes, that together are all there is to remove."""
    found = written(anchors(docs, length), "suffix-found")
    shared = written(met(found.where("goes")), "suffix-anchors")
    some = shared.where("differs and first")
    busy = some.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > most_contexts).select("anchor")
    busy = written(busy, "suffix-busy")
    wanted = some.groupBy("doc_id", "h").agg(F.collect_list(F.struct("anchor", "start", "size")).alias("wanted"))
    s, w = _source(docs).alias("s"), wanted.alias("w")
    text = s.join(w, F.col("s.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("s.h") == F.col("w.h")))
    data = F.col("text").cast("binary")
    each = text.select("s.doc_id", "s.h", data.alias("bytes"), F.explode("wanted").alias("x"))
    piece = F.substring("bytes", (F.col("x.start") + 1).cast("int"), F.col("x.size").cast("int"))
    contexts = written(each.select("x.anchor", "doc_id", "h", "x.start", piece.alias("data")), "suffix-contexts")
    ends = context_marks(contexts.join(busy, "anchor", "left_anti"), length)
    if not busy.isEmpty():
        ends = ends.union(window_marks(contexts.join(busy, "anchor", "left_semi"), length))
    whole = shared.where("whole").select("doc_id", "h", "start", "size")
    rest = found.where("many and not goes").select("doc_id", "h", "start", "size")
    return written(whole.union(rest).union(ends), "suffix-marks")


def covered(size: int, pieces: list[dict]) -> np.ndarray:
    """Which of some bytes lie in a piece."""
    depth = np.zeros(size + 1, np.int64)
    np.add.at(depth, [p["start"] for p in pieces], 1)
    np.add.at(depth, [p["start"] + p["size"] for p in pieces], -1)
    return np.cumsum(depth[:-1]) > 0


def removed(docs: DataFrame, length: int = 200, **options) -> DataFrame:
    """Per row: `doc_id, n_bytes, n_removed, n_spans, kept_sha256`, and `kept`, the bytes that stay."""
    per = marks(docs, length, **options).groupBy("doc_id", "h").agg(F.collect_set(F.struct("start", "size")).alias("pieces"))

    @F.arrow_udf("struct<n_removed: bigint, n_spans: bigint, kept: binary>")
    def cut(text: pa.Array, pieces: pa.Array) -> pa.Array:
        out = []
        for t, p in zip(text, pieces):
            if not p.is_valid:
                out.append(None)
                continue
            a = np.frombuffer(t.as_buffer(), np.uint8)
            gone = covered(len(a), p.as_py())
            spans = int((gone[1:] & ~gone[:-1]).sum()) + bool(len(gone) and gone[0])
            out.append({"n_removed": int(gone.sum()), "n_spans": spans, "kept": a[~gone].tobytes()})
        return pa.array(out, pa.struct([("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]))

    s, p = _source(docs).alias("s"), per.alias("p")
    joined = s.join(p, F.col("s.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("s.h") == F.col("p.h")), "left")
    # Only texts that lose something leave the JVM.
    some = F.when(F.col("pieces").isNotNull(), F.col("text"))
    done = joined.select("s.doc_id", "text", cut(some, F.col("pieces")).alias("c"))
    kept = F.coalesce(F.col("c.kept"), F.col("text").cast("binary"))
    zero = F.lit(0).cast("long")
    return done.select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.coalesce("c.n_removed", zero).alias("n_removed"),
        F.coalesce("c.n_spans", zero).alias("n_spans"),
        F.sha2(kept, 256).alias("kept_sha256"),
        kept.alias("kept"),
    )
