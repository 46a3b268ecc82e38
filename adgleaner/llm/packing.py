"""Best-fit packing into sequences of several permitted lengths.

Pieces of documents go, longest first, into the open bin that they leave least
room in. Where none has room, every permitted length is filled on trial with the
pieces still to come, and the one with the least cost per token placed opens.
When all are placed, each bin shrinks to the shortest permitted length that
holds its contents. Other bins may take what a trial counted on, so each shard is
packed in two more ways, and the cheapest is kept: bins filled one at a time by
the same trial, which nothing else takes from, and bins that open at the smallest
length that holds the piece.

Only ids and lengths travel; they are dealt into shards of about
`pieces_per_shard` rows by number, never by a key, and each shard is packed on
its own, so that no task grows with the input or with a repeated id. The price
is a few bins per shard that are not full, and those shrink.

Defined results: null and empty texts have length 0 and lie in no bin (bin_id
null, capacity 0); a text longer than the longest bin is cut into pieces of
that length and a rest; ties are broken by id and start; repeated rows are packed
each; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from adgleaner.llm.common import written

LENGTHS = (1024, 2048, 4096, 8192)
SCHEMA = "doc_id bigint, start bigint, length bigint, bin_id bigint, capacity bigint, offset bigint"


def linear_and_square(length: int) -> float:
    """Cost of one sequence: linear work, plus attention that grows with the square."""
    return length * (1 + length / 16384)


def pieces(docs: DataFrame, length: Column, longest: int) -> DataFrame:
    size = F.coalesce(length, F.lit(0)).cast("long")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n") - 1, F.lit(0)), F.lit(longest).cast("long"))
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("n"))
        .select("doc_id", "n", F.explode(starts).alias("start"))
        .select("doc_id", "start", F.least(F.col("n") - F.col("start"), F.lit(longest)).alias("length"))
    )


def pack(
    sizes: Iterable[int], lengths: tuple[int, ...] = LENGTHS, cost: Callable[[int], float] = linear_and_square
) -> tuple[list[tuple[int, int]], list[int]]:
    """Bin and offset of each size, in the given order, and the final length of each bin.

    Bins open by cost over what is still to come, whatever of it fits: the smallest length
    that holds the piece, where cost per token rises with length. Sizes must come longest first, and none may exceed the longest permitted length.
    """
    sizes, lengths = list(sizes), tuple(sorted(lengths))
    price = {c: cost(c) for c in lengths}
    to_come = sum(sizes)
    used: list[int] = []
    room: list[int] = []  # distinct free sizes, ascending
    open_bins: dict[int, list[int]] = {}
    capacity: list[int] = []
    placed = []
    for size in sizes:
        at = bisect_left(room, size)
        if at < len(room):
            free = room[at]
            number = open_bins[free].pop()
            if not open_bins[free]:
                del open_bins[free], room[at]
        else:
            free = min((c for c in lengths if c >= size), key=lambda c: (price[c] / max(min(c, to_come), 1), c))
            number = len(used)
            used.append(0)
            capacity.append(free)
        placed.append((number, used[number]))
        used[number] += size
        to_come -= size
        left = free - size
        if left:
            if left not in open_bins:
                insort(room, left)
                open_bins[left] = []
            open_bins[left].append(number)
    return placed, [next(c for c in lengths if c >= u) for u in used]


def trial_fill(room: int, distinct: list[int], count: dict[int, int]) -> list[tuple[int, int]]:
    """Sizes, and how often each, that fill `room` longest first; `distinct` is ascending."""
    taken = []
    at = len(distinct)
    while room and (at := bisect_right(distinct, room, 0, at) - 1) >= 0:
        size = distinct[at]
        n = min(count[size], room // size)
        taken.append((size, n))
        room -= n * size
    return taken


def _cheapest_length(
    size: int, distinct: list[int], count: dict[int, int], lengths: tuple[int, ...], price: dict[int, float]
) -> tuple[int, list[tuple[int, int]]]:
    """The length to open for a piece of `size`, by cost per token, and the trial fill that says so."""
    trials = []
    for c in lengths:
        if c >= size:
            taken = trial_fill(c - size, distinct, count)
            tokens = size + sum(s * n for s, n in taken)
            final = next(x for x in lengths if x >= tokens)
            trials.append((price[final] / tokens, c, taken))
    _, c, taken = min(trials, key=lambda x: x[:2])
    return c, taken


def _take(size: int, n: int, distinct: list[int], count: dict[int, int]) -> None:
    count[size] -= n
    if not count[size]:
        del distinct[bisect_left(distinct, size)]


def pack_ahead(
    sizes: Iterable[int], lengths: tuple[int, ...] = LENGTHS, cost: Callable[[int], float] = linear_and_square
) -> tuple[list[tuple[int, int]], list[int], list[int]]:
    """As `pack`, but bins open by trial; also returns the length each bin was opened with."""
    sizes, lengths = list(sizes), tuple(sorted(lengths))
    price = {c: cost(c) for c in lengths}
    count = Counter(sizes)
    distinct = sorted(count)
    used: list[int] = []
    room: list[int] = []
    open_bins: dict[int, list[int]] = {}
    opened: list[int] = []
    placed = []
    for size in sizes:
        _take(size, 1, distinct, count)
        at = bisect_left(room, size)
        if at < len(room):
            free = room[at]
            number = open_bins[free].pop()
            if not open_bins[free]:
                del open_bins[free], room[at]
        else:
            free, _ = _cheapest_length(size, distinct, count, lengths, price)
            number = len(used)
            used.append(0)
            opened.append(free)
        placed.append((number, used[number]))
        used[number] += size
        left = free - size
        if left:
            if left not in open_bins:
                insort(room, left)
                open_bins[left] = []
            open_bins[left].append(number)
    return placed, [next(c for c in lengths if c >= u) for u in used], opened


def pack_by_bin(
    sizes: Iterable[int], lengths: tuple[int, ...] = LENGTHS, cost: Callable[[int], float] = linear_and_square
) -> tuple[list[tuple[int, int]], list[int]]:
    """As `pack`, but each bin is filled by its trial before the next one opens."""
    sizes, lengths = list(sizes), tuple(sorted(lengths))
    price = {c: cost(c) for c in lengths}
    count = Counter(sizes)
    distinct = sorted(count)
    spots: dict[int, list[tuple[int, int]]] = {s: [] for s in distinct}
    final: list[int] = []
    while distinct:
        size = distinct[-1]
        _take(size, 1, distinct, count)
        _, taken = _cheapest_length(size, distinct, count, lengths, price)
        at = 0
        for s, n in [(size, 1), *taken]:
            spots[s] += [(len(final), at + k * s) for k in range(n)]
            at += n * s
        for s, n in taken:
            _take(s, n, distinct, count)
        final.append(next(c for c in lengths if c >= at))
    given = {s: iter(spots[s]) for s in spots}
    return [next(given[s]) for s in sizes], final


def pack_cheapest(
    sizes: Iterable[int], lengths: tuple[int, ...] = LENGTHS, cost: Callable[[int], float] = linear_and_square
) -> tuple[list[tuple[int, int]], list[int]]:
    """The cheapest of the three ways, the first of equals."""
    sizes = list(sizes)
    ways = pack_ahead(sizes, lengths, cost)[:2], pack_by_bin(sizes, lengths, cost), pack(sizes, lengths, cost)
    return min(ways, key=lambda way: sum(map(cost, way[1])))


def pack_documents(
    docs: DataFrame,
    length: Column | None = None,
    lengths: tuple[int, ...] = LENGTHS,
    cost: Callable[[int], float] = linear_and_square,
    pieces_per_shard: int = 20_000,
) -> DataFrame:
    """One row per piece: where it starts, its bin, the bin's final length, and its place in it."""
    length = F.length("text") if length is None else length
    cut = written(pieces(docs, length, max(lengths)), "packing-pieces")
    empty = cut.where("length = 0").select(
        "doc_id", "start", "length", F.lit(None).cast("long").alias("bin_id"),
        F.lit(0).cast("long").alias("capacity"), F.lit(0).cast("long").alias("offset"),
    )
    full = cut.where("length > 0")
    shards = -(-full.count() // pieces_per_shard) or 1

    def pack_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        t = pa.Table.from_batches(rows)
        t = t.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        placed, final = pack_cheapest(t["length"].to_pylist(), lengths, cost)
        first = TaskContext.get().partitionId() << 32
        columns = {
            "bin_id": [first + b for b, _ in placed],
            "capacity": [final[b] for b, _ in placed],
            "offset": [o for _, o in placed],
        }
        for name, values in columns.items():
            t = t.append_column(name, pa.array(values, pa.int64()))
        yield from t.to_batches(10_000)

    return full.repartition(shards).mapInArrow(pack_shard, SCHEMA).unionByName(empty)
