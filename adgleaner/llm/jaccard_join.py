"""Similarity join of word shingles: partitions of the universe and the pigeonhole principle.

Two sets with Jaccard similarity of at least t differ in at most
H = (1 - t) / (1 + t) * (|x| + |y|) elements. Hash the universe of shingles into m
segments: each difference spoils one segment, so all but H agree. Which segments
are compared depends on sizes only, in bands whose ends are a factor 1 / t apart;
a similar pair lies in one band or in two neighbouring ones, and each pair of
bands has its own m.

The finest partition comes first: each shingle is a segment of its own. Then only
what a set lacks in the other spoils its segments, |x| - ceil(t |x|) at most,
whatever the partner's size. Keys are taken in one order for all sets, frequent
shingles last; the first |x| - ceil(t |x|) + l hold at least l that a similar set
has too among its own first. Sets that share fewer have no partner; neither has
one whose size no other set of the key comes near. Which shingles are frequent
decides the cost only.

Where very many sets share such a key, it tells little: its sets are compared by
segments of several elements instead, of which a similar pair shares one as well.
Within a pair of bands one of two ways is chosen by the cheaper estimate of keys
per document and of documents that the way serves badly:

subset     m is large. A document has a key per segment that is not empty, and of
           those it emits the H + 1 largest (by elements, then hash). If the pair
           agrees on a segment at all, the first such in that order is within the
           first H + 1 of either.
deletion   m = H / 2 + 2. Segments of a pair differ by at most one element in all
           but H / 2 of them. A document emits each segment and each segment
           without one of its elements, so that such a pair meets in a key.

A document with too few segments that are not empty (or, in the second way, of
two elements) also emits the empty ones; only such documents meet there.

Equal sets become one class first, so that copies are not joined with each other.
Documents that share a key are candidates. They are verified against stars, one
centre per key, then connected: parity bitmaps bound the difference from below, and
what they do not rule out is counted exactly. What is still apart, such as many copies
of one text that are all too far from each other, is, once for all their keys, compared in blocks, which count
all their pairs exactly and return only links that connect components, fewer than
they hold sets. In the end, every candidate pair is verified, ruled out or connected.

Shingles and sets are compared by 64-bit hashes. Null and empty texts have no
shingles and are linked with nothing; repeated rows are linked; a null id
takes the smallest id of its component; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adgleaner.llm.common import batches_of_bytes, written
from adgleaner.llm.tokens import BLANK, mix as _mix, word_hashes, word_places

WIDTH = 5
_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_BASE = _U(0x100000001B3)
_CHUNK = 1 << 20
# More ids than this are never broadcast.
MAX_BROADCAST_IDS = 1_000_000
# Shingles that come last in the order of keys, at most; counted within so many shingles at a time.
MAX_FREQUENT = 100_000
_COUNTED = 1 << 20
# Tokens of a block of sets, about.
_BLOCK_TOKENS = 1 << 17


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _word_hashes(text: bytes) -> np.ndarray:
    a = np.frombuffer(text, np.uint8)
    out, start = [], 0
    while start < len(a):
        end = min(start + _CHUNK, len(a))
        if end < len(a):  # cut at a blank; a longer word is taken whole
            more = np.flatnonzero(BLANK[a[end:]])
            end = end + int(more[0]) if len(more) else len(a)
        part = _LOWER[a[start:end]]
        first, last, _ = word_places(part, np.array([0, len(part)]), ~BLANK)
        out.append(word_hashes(part, first, last))
        start = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a list of word hashes."""
    if not len(words):
        return words
    width = min(WIDTH, len(words))
    n = len(words) - width + 1
    h = np.full(n, width, np.uint64)
    for k in range(width):
        h = _mix(h * _ODD + words[k : k + n])
    return np.unique(h)


class Shingler:
    """Shingle sets of texts given as bytes."""

    def of(self, text: pa.Scalar) -> np.ndarray:
        return shingle_set(_word_hashes(text.as_buffer() or b""))

    @staticmethod
    def known_by(tokens: np.ndarray) -> int:
        return int((_mix(tokens).sum() ^ _U(len(tokens))).astype(np.int64))


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")


def _parts(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))


def scanned(docs: DataFrame) -> DataFrame:
    """`doc_id, h, n_shingles, cid, often`: per row the size of its set, and what the set is known by; `h` tells texts of one id apart.

    Rows with `often` are no documents: `cid` is a shingle that so many sets had among those that a task counted together.
    """

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, names = Shingler(), ["doc_id", "h", "n_shingles", "cid", "often"]
        held: dict[int, np.ndarray] = {}

        def frequent() -> pa.RecordBatch:
            u, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *held.values()]), return_counts=True)
            u, n = u[n > 2], n[n > 2]
            none = pa.nulls(len(u), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, none, pa.array(u.view(np.int64)), pa.array(n, pa.int64())], names)

        with np.errstate(over="ignore"):
            for part in _parts(batches, 1000):
                sizes, ids, total = [], [], sum(map(len, held.values()))
                for s in map(shingler.of, part.column(2)):
                    sizes.append(len(s))
                    ids.append(shingler.known_by(s) if len(s) else None)
                    if len(s) and ids[-1] not in held:
                        if total + len(s) > _COUNTED:
                            yield frequent()
                            held.clear()
                            total = 0
                        held[ids[-1]] = s
                        total += len(s)
                columns = [*part.columns[:2], pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), pa.nulls(len(ids), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names)
            yield frequent()

    return _source(docs).mapInArrow(of_batch, "doc_id long, h long, n_shingles long, cid long, often long")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """`doc_id, h, n_shingles, cid` of every row."""
    return scanned(docs).where("often IS NULL").drop("often")


class Order:
    """Shingles from rare to frequent, equally frequent ones by hash, and the keys that a set has in this order."""

    def __init__(self, threshold: int, frequent: DataFrame | None = None):
        self.t = threshold
        self.tokens, self.often = np.zeros(1, np.uint64), np.zeros(1, np.int64)
        if frequent is not None:
            total = frequent.groupBy("cid").agg(F.sum("often").alias("n")).orderBy(F.desc("n"), "cid").limit(MAX_FREQUENT)
            rows = total.toArrow()
            if rows.num_rows:
                tokens = rows["cid"].to_numpy().view(np.uint64)
                at = np.argsort(tokens)
                self.tokens, self.often = tokens[at], rows["n"].to_numpy()[at]

    def least(self, n: int) -> int:
        """The fewest elements that a set of n shares with a similar one."""
        return -(-self.t * n // 100)

    def wanted(self, n: int) -> int:
        """How many keys two similar sets share, if neither has fewer than n elements."""
        return 1 + (self.least(n) - 1) // 32

    def fewest(self, n: int) -> int:
        """How many keys a set of n elements shares with a similar one of any size."""
        return self.wanted(self.least(n))

    def keys(self, tokens: np.ndarray) -> np.ndarray:
        """The first keys of a set of sorted distinct hashes."""
        n = len(tokens)
        count = n - self.least(n) + self.wanted(n)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        often = np.where(self.tokens[at] == tokens, self.often[at], 0)
        rare = tokens[often == 0]
        return rare[:count] if len(rare) >= count else tokens[np.argsort(often, kind="stable")[:count]]


class Allocation:
    """For each pair of bands: the number of segments, and the way."""

    def __init__(self, threshold: int, longest: int):
        self.t = threshold
        self.starts = [1]
        while self.starts[-1] <= longest:
            self.starts.append(100 * self.starts[-1] // threshold + 1)
        self.starts += [100 * self.starts[-1] // threshold + 1, 10**18]
        self.ways = [self._choose(k) for k in range(len(self.starts) - 2)]

    def differences(self, sizes: int) -> int:
        """The most in which two sets of so many elements together may differ."""
        return sizes * (100 - self.t) // (100 + self.t)

    def band(self, n: int) -> int:
        import bisect

        return bisect.bisect_right(self.starts, n) - 1

    def reach(self, n: int, lower: bool, k: int) -> int:
        """The most in which a set of n elements may differ from a partner, in the pair of bands k and k + 1."""
        partner = min(100 * n // self.t, self.starts[k + 2] - 1) if lower else self.starts[k + 1] - 1
        return self.differences(n + partner)

    def _choose(self, k: int) -> tuple[bool, int]:
        """Whether by deletion, and the number of segments."""
        top = self.starts[k + 1] - 1
        most = self.differences(top + min(100 * top // self.t, self.starts[k + 2] - 1))
        n = max(self.starts[k], (self.starts[k] + top) // 2)
        reach = self.reach(n, True, k)
        subset, deletion = max(most + 1, -(-top // 2)), most // 2 + 2
        costs = []
        for by_deletion, m, keys in ((False, subset, reach + 1), (True, deletion, n + deletion)):
            spoilt = self._too_few(n, m, reach // 2 + 1 if by_deletion else reach + 1, 2 if by_deletion else 1)
            costs.append((keys + 1000 * spoilt, by_deletion, m))
        return min(costs)[1:]

    @staticmethod
    def _too_few(n: int, m: int, wanted: int, least: int) -> float:
        """Estimated share of sets with fewer than `wanted` segments of at least `least` elements."""
        x = n / m
        p = 1 - math.exp(-x) * (1 if least == 1 else 1 + x)
        mean, spread = m * p, math.sqrt(m * p * (1 - p)) + 1e-9
        return 0.5 * math.erfc((mean - wanted + 0.5) / spread / math.sqrt(2))

    def keys(self, tokens: np.ndarray) -> np.ndarray:
        """All keys of a set of sorted distinct hashes."""
        n = len(tokens)
        b = self.band(n)
        out = [self._keys_in(tokens, b, True)]
        if b:
            out.append(self._keys_in(tokens, b - 1, False))
        return np.concatenate(out)

    def _keys_in(self, tokens: np.ndarray, k: int, lower: bool) -> np.ndarray:
        by_deletion, m = self.ways[k]
        reach = self.reach(len(tokens), lower, k)
        segment = ((tokens >> _U(32)) * _U(m)) >> _U(32)
        first = np.concatenate([[0], np.flatnonzero(segment[1:] != segment[:-1]) + 1])
        mixed = _mix(tokens + _U(k + 1) * _ODD)
        total = np.add.reduceat(mixed, first)
        count = np.diff(np.concatenate([first, [len(tokens)]]))
        number = segment[first]
        salt = _mix(number + _U(k + 1) * _BASE)
        key = _mix(total + salt)
        if not by_deletion:
            if len(key) <= reach:
                return np.concatenate([key, self._empty(number, m, k)])
            order = (np.minimum(count, 255).astype(np.uint64) ^ _U(255)) << _U(56) | key >> _U(8)
            return key if len(key) == reach + 1 else key[np.argpartition(order, reach)[: reach + 1]]
        without = _mix(np.repeat(total + salt, count) - mixed)
        if int((count >= 2).sum()) <= reach // 2:
            return np.concatenate([key, without, self._empty(number, m, k)])
        return np.concatenate([key, without[np.repeat(count, count) > 1]])

    @staticmethod
    def _empty(number: np.ndarray, m: int, k: int) -> np.ndarray:
        rest = np.setdiff1d(np.arange(m, dtype=np.uint64), number)
        return _mix(_mix(rest + _U(k + 1) * _BASE))


def _keyed(ids: list[int], sizes: list[int], keys: list[np.ndarray]) -> pa.RecordBatch:
    many = [len(k) for k in keys]
    key = np.concatenate([np.zeros(0, np.uint64), *keys])
    n, cid = np.repeat(np.array(sizes, np.int32), many), np.repeat(np.array(ids, np.int64), many)
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n), pa.array(cid)], ["key", "n", "cid"])


_RUNS = "key long, n int, cid long"


def shingle_keys(docs: DataFrame, order: Order) -> DataFrame:
    """`key, n, cid` of every set. A task gives the keys of a set that it meets again only once."""

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(), set()
        with np.errstate(over="ignore"):
            for part in _parts(batches, 500):
                ids, sizes, keys = [], [], []
                for tokens in map(shingler.of, part.column(2)):
                    cid = shingler.known_by(tokens) if len(tokens) else None
                    if cid is None or cid in seen:
                        continue
                    if len(seen) >= 1_000_000:  # only spares work; forgetting is harmless
                        seen.clear()
                    seen.add(cid)
                    ids.append(cid)
                    sizes.append(len(tokens))
                    keys.append(order.keys(tokens))
                yield _keyed(ids, sizes, keys)

    return _source(docs).mapInArrow(of_batch, _RUNS)


def segment_keys(sets: DataFrame, allocation: Allocation) -> DataFrame:
    """`key, n, cid` of some sets, by segments."""

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for part in _parts(batches, 500):
                tokens = [np.frombuffer(t.as_buffer(), np.uint64) for t in part.column(1)]
                yield _keyed(part.column(0).to_pylist(), [len(t) for t in tokens], [allocation.keys(t) for t in tokens])

    return sets.select("cid", "tokens").mapInArrow(of_batch, _RUNS)


def shared_keys(keys: DataFrame, threshold: int) -> DataFrame:
    """The distinct rows whose key a set of similar size has too. One row is held at a time, however long a run is.

    Rows of a key come by size, so that a row with a partner has a neighbour in reach.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "n", "cid"]
        held, with_last = None, False  # the last distinct row, and whether it is in reach of the one before
        for batch in batches:
            k, n, c = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if held is not None:
                k, n, c = (np.concatenate([h, x]) for h, x in zip(held, (k, n, c)))
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
            k, n, c = k[new], n[new], c[new]
            if not len(k):
                continue
            same = (k[1:] == k[:-1]) & (100 * n[:-1].astype(np.int64) >= threshold * n[1:].astype(np.int64))
            before = np.concatenate([[with_last], same])
            after = np.concatenate([same, [False]])
            out = (before | after)[:-1]
            held, with_last = (k[-1:], n[-1:], c[-1:]), bool(before[-1])
            yield pa.RecordBatch.from_arrays([pa.array(x[:-1][out]) for x in (k, n, c)], names)
        if held is not None and with_last:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names)

    return keys.repartition("key").sortWithinPartitions("key", "n", "cid").mapInArrow(runs, _RUNS)


def with_enough(runs: DataFrame, order: Order) -> DataFrame:
    """The rows of sets that share as many keys as a similar one would have in common with them."""
    counts = runs.groupBy("cid").agg(F.count("*").alias("keys"), F.first("n").alias("size"))
    least = f"({order.t} * size + 99) div 100"
    fewest = F.expr(f"1 + (({order.t} * ({least}) + 99) div 100 - 1) div 32")  # `order.fewest`
    enough = counts.where(F.col("keys") >= fewest).select("cid")
    return runs.join(enough, "cid", "left_semi").select("key", "n", "cid")


def _bitmap(tokens: np.ndarray) -> bytes:
    """Parity of the elements that fall on each of 2^b bits, at least two bits per element."""
    bits = max(64, 1 << (2 * len(tokens) - 1).bit_length())
    at = (tokens * _ODD >> _U(64 - bits.bit_length() + 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits) & 1).tobytes()


def _folded(bitmap: np.ndarray, size: int) -> np.ndarray:
    """A bitmap, or a row of them, at `size` bytes. Bits are numbered by leading bits of the hash: neighbours fold together."""
    while bitmap.shape[-1] > size:
        bits = np.unpackbits(bitmap, axis=-1)
        bitmap = np.packbits(bits[..., ::2] ^ bits[..., 1::2], axis=-1)
    return bitmap


def _apart(x: bytes, y: bytes) -> int:
    """A lower bound on the number of elements that are in one set only."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    size = min(len(a), len(b))
    return int(np.bitwise_count(_folded(a, size) ^ _folded(b, size)).sum())


def only(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """The sets with one of some ids. Tokens are wide: what no pair needs is left out before they move."""
    ids = ids.distinct()
    # A checked size: beyond it, both sides are shuffled.
    return sets.join(F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids, "cid", "left_semi")


def block_links(left: list[dict], right: list[dict], threshold: int) -> list[tuple[int, int]]:
    """Links across two blocks that connect their components, none of them implied by the others."""
    root = {r["comp"]: r["comp"] for r in (*left, *right)}
    if len(root) == 1:
        return []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    sides = [[np.frombuffer(r["tokens"], np.uint64) for r in side] for side in (left, right)]
    known = np.intersect1d(*(np.concatenate(side) for side in sides))
    held = []
    for side in sides:
        # Which of the tokens that both blocks have are in which set.
        of = np.repeat(np.arange(len(side)), [len(t) for t in side])
        tokens = np.concatenate(side)
        at = np.minimum(np.searchsorted(known, tokens), max(len(known) - 1, 0))
        there = known[at] == tokens if len(known) else np.zeros(len(tokens), bool)
        matrix = np.zeros((len(side), len(known)), np.float32)
        matrix[of[there], at[there]] = 1
        held.append(matrix)
    both = (held[0] @ held[1].T).astype(np.int64)  # numbers below 2^24 are exact
    n, m = (np.array([len(t) for t in side]) for side in sides)
    out = []
    for i, j in zip(*np.nonzero(100 * both >= threshold * (n[:, None] + m[None, :] - both))):
        x, y = find(left[i]["comp"]), find(right[j]["comp"])
        if x != y:
            root[x] = y
            out.append((left[i]["cid"], right[j]["cid"]))
    return out


def _merged(runs: DataFrame, few: int) -> DataFrame:
    """`runs` with keys that have many sets in common made one, where that leaves fewer pairs. No two sets lose a shared key."""
    count = runs.groupBy("key").agg(F.count("*").alias("members"))
    large = runs.join(count.where(F.col("members") > few), "key")
    # A set names its least key; a key goes by the least name among its sets.
    name = large.groupBy("cid").agg(F.min("key").alias("name"))
    names = large.join(name, "cid").groupBy("key", "members").agg(F.min("name").alias("name"))
    names = written(names, "join-names")
    apart = names.groupBy("name").agg(F.sum(F.col("members") * F.col("members")).alias("pairs"))
    together = runs.join(names.select("key", "name"), "key").groupBy("name").agg(F.countDistinct("cid").alias("sets"))
    better = together.join(apart, "name").where(F.col("sets") * F.col("sets") < F.col("pairs")).select("name")
    names = names.join(better, "name", "left_semi").select("key", "name")
    return runs.join(names, "key", "left").withColumn("key", F.coalesce("name", "key")).drop("name").distinct()


def pairs_apart(runs: DataFrame, sets: DataFrame, threshold: int, size: int = 64, few: int = 64) -> tuple[DataFrame, DataFrame]:
    """What is left of `runs`: pairs (a, b) that share a key and are in different components, and links.

    Members of a key that up to `few` sets share are paired as rows. Those of a
    larger one are dealt into blocks of about `size`, fewer of large sets; a row is
    a pair of blocks, compared within its task. So a key that n sets share makes
    rows of a number of (n / size) squared, and a pair of blocks gives fewer links
    than it has sets.
    """
    runs = written(_merged(runs, few), "join-merged")
    count = runs.groupBy("key").agg(F.count("*").alias("members"), F.sum(F.col("n").cast("long")).alias("tokens"))
    blocks = F.ceil(F.greatest(F.col("members") / size, F.col("tokens") / _BLOCK_TOKENS)).alias("blocks")
    counted = written(runs.join(count.select("key", "members", blocks), "key"), "join-counted")
    one, two = (counted.where(F.col("members") <= few).select("key", F.col("cid").alias(c), F.col("comp").alias(f"{c}_comp")) for c in "ab")
    paired = one.join(two, "key").where("a < b and a_comp != b_comp").select("a", "b")
    large = counted.where(F.col("members") > few).drop("n")
    placed = large.join(only(sets.select("cid", "tokens"), large.select("cid")), "cid")
    block = F.pmod(F.xxhash64("cid", "key"), F.col("blocks"))
    one = F.struct("cid", "comp", "tokens")
    blocks = written(placed.groupBy("key", block.alias("block")).agg(F.collect_list(one).alias("rows")), "join-blocks")
    both = blocks.toDF("key", "i", "left").join(blocks.toDF("key", "j", "right"), "key").where("i <= j")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: set[tuple[int, int]] = set()
            for r in _parts([batch], 1):
                row = r.to_pylist()[0]
                found.update(block_links(row["left"], row["right"], threshold))
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    # Rows are wide: some 100 KB a block.
    with batches_of_bytes(runs.sparkSession):
        links = written(both.select("left", "right").mapInArrow(compare, "a long, b long").distinct(), "join-apart")
    return paired, links


def candidate_sets(docs: DataFrame, members: DataFrame, ids: DataFrame) -> DataFrame:
    """`cid, n, tokens, bitmap` of some sets, from one text of each."""
    one = members.join(ids, "cid").groupBy("cid").agg(F.min(F.struct("doc_id", "h")).alias("r"))
    one = written(one.select("r.doc_id", "r.h"), "join-texts")
    # A checked size: beyond it, both sides are shuffled.
    wanted = (F.broadcast(one) if one.count() <= MAX_BROADCAST_IDS else one).alias("w")

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        with np.errstate(over="ignore"):
            for part in _parts(batches, 1000):
                sets = [shingler.of(t) for t in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shingler.known_by(s) for s in sets], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                        pa.array([_bitmap(s) for s in sets], pa.binary()),
                    ],
                    ["cid", "n", "tokens", "bitmap"],
                )

    s = _source(docs).alias("s")
    texts = s.join(wanted, F.col("s.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("s.h") == F.col("w.h")), "left_semi")
    sets = texts.mapInArrow(of_batch, "cid long, n long, tokens binary, bitmap binary")
    with batches_of_bytes(docs.sparkSession):
        return written(sets.dropDuplicates(["cid"]), "join-sets")


def verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose similarity reaches the threshold: bitmaps first, then the exact count."""

    @F.arrow_udf("boolean")
    def may(x: pa.Array, y: pa.Array, n: pa.Array) -> pa.Array:
        most = n.to_numpy(zero_copy_only=False) * (100 - threshold) // (100 + threshold)
        return pa.array([_apart(p.as_py(), q.as_py()) <= m for p, q, m in zip(x, y, most)], pa.bool_())

    @F.arrow_udf("boolean")
    def exact(x: pa.Array, y: pa.Array) -> pa.Array:
        def one(p: pa.Scalar, q: pa.Scalar) -> bool:
            a, b = np.frombuffer(p.as_py(), np.uint64), np.frombuffer(q.as_py(), np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            return 100 * both >= threshold * (len(a) + len(b) - both)

        return pa.array([one(p, q) for p, q in zip(x, y)], pa.bool_())

    def on(frame: DataFrame, side: str, column: str, sets: DataFrame) -> DataFrame:
        other = sets.select(F.col("cid").alias(side), F.col(column).alias(f"{side}_{column}"), F.col("n").alias(f"{side}_n"))
        return frame.join(other, side)

    near = on(on(pairs, "a", "bitmap", sets), "b", "bitmap", sets)
    near = near.where(100 * F.least("a_n", "b_n") >= threshold * F.greatest("a_n", "b_n"))
    left = written(near.where(may("a_bitmap", "b_bitmap", F.col("a_n") + F.col("b_n"))).select("a", "b"), "join-near")
    needed = only(sets.select("cid", "n", "tokens"), left.select(F.col("a").alias("cid")).union(left.select("b")))
    both = on(on(left, "a", "tokens", needed).drop("a_n"), "b", "tokens", needed)
    with batches_of_bytes(pairs.sparkSession):
        return written(both.where(exact("a_tokens", "b_tokens")).select("a", "b"), "join-links")


def components(links: DataFrame) -> DataFrame:
    """`node, root`: the least node reachable, for every node of some links (a, b).

    Each round a node takes the least root among its neighbours, and then the
    root of its root, so that paths halve. Tables are written between rounds.
    """
    both = written(links.union(links.select("b", "a")).toDF("node", "other").distinct(), "join-edges")
    roots = written(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root")), "join-roots")
    while True:
        of = roots.toDF("other", "other_root")
        least = both.join(of, "other").groupBy("node").agg(F.min("other_root").alias("near"))
        step = roots.join(least, "node").select("node", "root", F.least("root", "near").alias("next"))
        of = roots.toDF("next", "root_of_next")
        jumped = step.join(of, "next").select("node", "root", F.least("next", "root_of_next").alias("new"))
        now = written(jumped, "join-roots")
        if now.where("root != new").isEmpty():
            return roots
        roots = now.select("node", F.col("new").alias("root"))


def _joined(state: DataFrame, links: DataFrame) -> DataFrame | None:
    """`comp, root` of the components that links between ids join to another; None if there are none."""
    of = lambda side: state.toDF(side, f"{side}_comp")
    between = links.join(of("a"), "a").join(of("b"), "b").select("a_comp", "b_comp").where("a_comp != b_comp").distinct()
    between = written(between.toDF("a", "b"), "join-between")
    if between.isEmpty():
        return None
    roots = components(between).where("node != root").toDF("comp", "root")
    return F.broadcast(roots) if roots.count() <= MAX_BROADCAST_IDS else roots


def _moved(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """`rows` with the components that they are in now. Only what has changed comes to them."""
    return rows.join(roots, "comp", "left").withColumn("comp", F.coalesce("root", "comp")).drop("root")


def linked_classes(
    docs: DataFrame, members: DataFrame, threshold: int = 75, rounds: int = 4, frequent: DataFrame | None = None, many: int = 10_000
) -> DataFrame:
    """`cid, comp` of the classes that share a key with another: the classes connected by links.

    Sets of a key that more than `many` share are compared by segments.
    """
    spark = docs.sparkSession
    order = Order(threshold, frequent)
    with batches_of_bytes(spark):
        runs = written(shared_keys(shingle_keys(docs, order), threshold), "join-shared")
    # What goes leaves keys to one set, so that more may go.
    for _ in range(2):
        runs = written(shared_keys(with_enough(runs, order), threshold), "join-runs")
    ids = written(runs.select("cid").distinct(), "join-ids")
    few = candidate_sets(docs, members, ids)
    full = written(runs.groupBy("key").agg(F.count("*").alias("sets")).where(F.col("sets") > many).select("key"), "join-full")
    if not full.isEmpty():
        longest = members.agg(F.max("n_shingles").alias("n")).first().n
        crowded = few.join(runs.join(full, "key", "left_semi").select("cid").distinct(), "cid", "left_semi")
        with batches_of_bytes(spark):
            segments = shared_keys(segment_keys(crowded, Allocation(threshold, longest)), threshold)
            runs = written(runs.join(full, "key", "left_anti").unionByName(segments), "join-runs")
    state = written(ids.select("cid", F.col("cid").alias("comp")), "join-state")
    runs = runs.select("key", "cid", F.col("cid").alias("comp"))

    def connect(links: DataFrame) -> None:
        nonlocal state, runs
        roots = _joined(state, links)
        if roots is not None:
            state, runs = written(_moved(state, roots).select("cid", "comp"), "join-state"), _moved(runs, roots)

    tested = spark.createDataFrame([], "a long, b long")
    for turn in range(rounds + 1):
        # Keys whose members are still apart, each with a centre that changes from turn to turn.
        # Rows move once in a turn, to their key: both sides of the join below read the same columns.
        placed = runs.repartition("key")
        centre = F.min(F.struct(F.xxhash64("cid", F.lit(turn)).alias("h"), "cid", "comp")).alias("c")
        spread = placed.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), centre)
        alive = spread.where("x != y").select("key", F.col("c.cid").alias("a"), F.col("c.comp").alias("a_comp"))
        runs = written(placed.join(alive, "key"), "join-open")
        if runs.isEmpty():
            break
        if turn < rounds:
            # Each is compared with the centre that it shares most keys with.
            shared = runs.where("comp != a_comp").groupBy("cid", "a").agg(F.count("*").alias("n"))
            best = shared.join(tested_with(tested), ["cid", "a"], "left_anti").groupBy("cid").agg(F.max_by("a", F.struct("n", "a")).alias("a"))
            cross = best.select("a", F.col("cid").alias("b"))
        else:
            # What no star has connected or refuted: members of a key that are in different components.
            sizes = few.select("cid", "n")
            sized = runs.join(F.broadcast(sizes) if sizes.count() <= MAX_BROADCAST_IDS else sizes, "cid")
            cross, links = pairs_apart(sized.select("key", "n", "cid", "comp"), few, threshold)
            connect(links)
        runs = runs.select("key", "cid", "comp")
        cross = cross.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = written(cross.join(tested, ["a", "b"], "left_anti"), "join-pairs")
        connect(verified(pairs, few, threshold))
        tested = tested.union(pairs)
    return state


def tested_with(pairs: DataFrame) -> DataFrame:
    """Pairs both ways round, as `cid, a`."""
    return pairs.toDF("cid", "a").union(pairs.select("b", "a").toDF("cid", "a"))


def _members(docs: DataFrame, threshold: int) -> DataFrame:
    """`doc_id, h, n_shingles, comp` per row; comp is null for a row without shingles."""
    with batches_of_bytes(docs.sparkSession):
        rows = written(scanned(docs), "join-all")
    sets = rows.where("often IS NULL").drop("often")
    comp = linked_classes(docs, sets, threshold, frequent=rows.where("often IS NOT NULL"))
    joined = sets.select("doc_id", "h", "n_shingles", "cid").join(comp, "cid", "left")
    return written(joined.select("doc_id", "h", "n_shingles", F.coalesce("comp", "cid").alias("comp")), "join-members")


def near_copies(docs: DataFrame, threshold: int = 75) -> DataFrame:
    """`doc_id, n_shingles, component_id`: per row, the smallest id reachable by links."""
    members = _members(docs, threshold)
    least = members.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("least"))
    component = F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return members.join(least, "comp", "left").select("doc_id", "n_shingles", component.alias("component_id"))


def one_of_each(docs: DataFrame, threshold: int = 75) -> DataFrame:
    """One document of each group of near copies, all columns as they were: the smallest id, null last.

    Documents without shingles all stay. Only what goes, and rows repeated with
    id and text, is joined back to the texts.
    """
    members = _members(docs, threshold).where("comp is not null")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    first = members.groupBy("comp").agg(F.min(rank).alias("first"))
    joined = members.join(first, "comp").withColumn("stays", rank == F.col("first"))
    gone = written(joined.where(~F.col("stays")).select("doc_id", "h").distinct(), "join-gone")
    repeated = written(
        joined.where("stays").groupBy("doc_id", "h").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "join-repeated"
    )
    h = F.xxhash64(docs["text"])

    def among(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        return rows.join(keys, rows["doc_id"].eqNullSafe(keys["doc_id"]) & (h == keys["h"]), how)

    kept = among(docs, gone, "left_anti")
    if repeated.isEmpty():
        return kept
    once = among(kept, repeated, "left_semi").dropDuplicates(["doc_id", "text"])
    return among(kept, repeated, "left_anti").unionByName(once)
