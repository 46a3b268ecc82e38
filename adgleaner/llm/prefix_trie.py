"""Prefix trie of conversations, rolled up by centroid decomposition of its parent edges.

Every distinct beginning of a conversation is a node. A node is named by its smallest member
and its depth, so that a conversation's own nodes are the end of its path, and an ancestor of
any node is one lookup in the table of all paths, `places`.

Sums over subtrees. Going down or up edge by edge takes as many rounds as the longest conversation
has turns. Instead the edges are cut at centroids:

1. The centroid of a component is its lowest node whose subtree within the component holds half of
   the component's nodes or more. Cut out, it leaves no component with more than half.
2. What is below a centroid is summed per component, is the centroid's own total, and is added to
   every node on the path from there to the top of the component; their sizes fall by what was cut.
3. Components beyond `most_nodes` nodes are cut so by joins: whether a node is below the centroid, and
   in which of its children's components, is read from `places`. The rounds are as many as halvings
   are needed, whatever the depth. What is small enough goes to one task each, many to a task, and
   is decomposed there in the same way.

Sequences are compared by two 64-bit hashes of their turns and places. Turns are ranked within a
conversation by range partitions and chained in chunks, so that no task needs to hold a conversation.
Only the ids that end at one node are read in one pass of one task each, as their joint hash has
to be taken in order; nothing is held but the hash.

Defined results: null role and text count as empty; a null turn comes first; turns with one
number stand by role, then text; repeated rows are repeated turns. Rows without conv_id belong to no
conversation. Without conversations there is no root and the result is empty. Texts of any
length are read whole, once. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from adgleaner.llm.common import written
from adgleaner.operators.skew import left_join_spread

# Turns that are chained in one window.
_CHUNK = 1024
# Nodes that a task decomposes at once, if single components have no more.
_AT_ONCE = 65_536


def ranked(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their place in the conversation from 1 on (`conv_id, pos, t1, t2, size`), and `conv_id, turns`.

    Rows are dealt out by ranges of conversation and turn; a place is one within its range plus the
    rows of the conversation in earlier ranges.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *text).where("conv_id IS NOT NULL")
    keys = ("conv_id", "turn", "role", "text")
    content = [F.xxhash64(F.lit(k), "role", "text").alias(f"t{k}") for k in (1, 2)]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id()
    dealt = written(dealt.select("conv_id", at.alias("at"), *content, F.char_length("text").cast("long").alias("size")), "trie-turns")
    dealt = dealt.withColumn("part", F.shiftright("at", 33))
    parts = dealt.groupBy("conv_id", "part").agg(F.min("at").alias("lo"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    pos = F.col("at") - F.col("lo") + F.col("before") + 1
    turns = dealt.join(parts, ["conv_id", "part"]).select("conv_id", pos.alias("pos"), "t1", "t2", "size")
    return turns, parts.groupBy("conv_id").agg(F.sum("n").alias("turns"))


def rebuilt(conversations: DataFrame, every: int = 100, most_shared: int = 6) -> tuple[DataFrame, DataFrame]:
    """Each conversation c as the first h turns of c - c % every, then its own after its first h; h = crc32(c) % most_shared.

    Returns `conv_id, depth, t1, t2, size`, and `conv_id, length` with conversations without turns.
    """
    turns, counts = ranked(conversations)
    turns, counts = written(turns, "trie-ranked"), written(counts, "trie-counts")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most_shared).alias("h")
    base = (F.col("conv_id") - F.col("conv_id") % every).alias("base")
    bases = counts.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.col("turns").alias("has"))
    convs = counts.select("conv_id", "turns", h, base).join(bases, "base", "left")
    shared = F.least("h", F.coalesce("has", F.lit(0)))
    own = F.greatest(F.col("turns") - F.col("h"), F.lit(0))
    convs = written(convs.select("conv_id", "base", "h", shared.alias("shared"), (shared + own).alias("length")), "trie-convs")
    begin = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") < most_shared)).withColumnRenamed("conv_id", "base")
    first = convs.join(begin, "base").where("pos <= h").select("conv_id", F.col("pos").alias("depth"), "t1", "t2", "size")
    # A conversation with very many turns is shifted in place.
    by = convs.select("conv_id", (F.col("shared") - F.col("h")).alias("shift"), "length")
    rest = left_join_spread(turns.where(F.col("pos") > h), by, "conv_id", "length", "pos")
    rest = rest.select("conv_id", (F.col("pos") + F.col("shift")).alias("depth"), "t1", "t2", "size")
    return first.union(rest), convs.select("conv_id", "length")


def chained(turns: DataFrame) -> DataFrame:
    """`conv_id, depth, size` and two hashes `p1, p2` of all turns up to there."""
    tags = [F.xxhash64("depth", f"t{k}").alias(f"x{k}") for k in (1, 2)]
    chunk = F.floor((F.col("depth") - 1) / _CHUNK).alias("chunk")
    turns = written(turns.select("conv_id", "depth", "size", chunk, *tags), "trie-tags")
    totals = turns.groupBy("conv_id", "chunk").agg(*[F.bit_xor(f"x{k}").alias(f"y{k}") for k in (1, 2)])
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("conv_id", "chunk", *[F.bit_xor(f"y{k}").over(earlier).alias(f"y{k}") for k in (1, 2)])
    within = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    inner = turns.select("conv_id", "chunk", "depth", "size", *[F.bit_xor(f"x{k}").over(within).alias(f"z{k}") for k in (1, 2)])
    both = inner.join(totals.where("y1 IS NOT NULL"), ["conv_id", "chunk"], "left")
    chain = [F.col(f"z{k}").bitwiseXOR(F.coalesce(f"y{k}", F.lit(0))).alias(f"p{k}") for k in (1, 2)]
    return both.select("conv_id", "depth", "size", *chain)


def trie(conversations: DataFrame, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes (`conv_id, depth, parent_conv_id, n_convs, size`), places (`member, depth, owner, next`) and `member, length`.

    `owner` is the smallest member of the node at that depth of a conversation's path, `next` that of the node below it.
    """
    turns, convs = rebuilt(conversations, **options)
    paths = written(chained(turns), "trie-paths").select(
        F.col("conv_id").alias("member"), "depth", "size", F.struct("p1", "p2", "depth").alias("prefix")
    )
    groups = paths.groupBy("prefix").agg(
        F.min("member").alias("owner"), F.count("*").alias("n_convs"), F.first("size").alias("size")
    )
    groups = written(groups, "trie-groups")
    weight = groups.select("prefix", "owner", "n_convs")
    below = left_join_spread(paths.select("member", "depth", "prefix"), weight, "prefix", "n_convs", "member")
    root = convs.agg(F.min("conv_id").alias("owner"), F.count("*").alias("n_convs")).where("n_convs > 0")
    least = convs.agg(F.min("conv_id").alias("owner")).scalar()
    top = convs.select(F.col("conv_id").alias("member"), F.lit(0).cast("long").alias("depth"), least.alias("owner"))
    owners = written(below.select("member", "depth", "owner").union(top), "trie-owners")
    lower = owners.select("member", (F.col("depth") - 1).alias("depth"), F.col("owner").alias("next"))
    places = written(owners.join(lower, ["member", "depth"], "left"), "trie-places")
    # The parent of a node is the place above it on its owner's path.
    upper = owners.select(F.col("member").alias("conv_id"), (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent_conv_id"))
    nodes = groups.select(F.col("owner").alias("conv_id"), F.col("prefix.depth").alias("depth"), "n_convs", "size")
    nodes = nodes.join(upper, ["conv_id", "depth"], "left")
    none = F.lit(None).cast("long").alias("parent_conv_id")
    rooted = root.select(F.col("owner").alias("conv_id"), F.lit(0).cast("long").alias("depth"), "n_convs", F.lit(0).cast("long").alias("size"), none)
    return written(nodes.union(rooted), "trie-nodes"), places, convs.withColumnRenamed("conv_id", "member")


def decompose(parent: np.ndarray, size: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sums over subtrees of a forest by centroids. `parent` is -1 at the tops; `size` counts the nodes of each subtree."""
    parent, size, total = parent.copy(), size.copy(), np.zeros_like(weights)
    active = np.arange(len(parent))
    while len(active):
        top = np.where(parent < 0, np.arange(len(parent)), parent)
        while True:
            higher = top[top]
            if np.array_equal(higher, top):
                break
            top = higher
        heavy = active[2 * size[active] >= size[top[active]]]
        order = np.lexsort((size[heavy], top[heavy]))
        heavy = heavy[order]
        first = np.ones(len(heavy), bool)
        first[1:] = top[heavy[1:]] != top[heavy[:-1]]
        centre = heavy[first]
        is_centre = np.zeros(len(parent), bool)
        is_centre[centre] = True
        # Its children become tops; it is a top without nodes below.
        up = parent[centre]
        child = active[(parent[active] >= 0) & is_centre[parent[active]]]
        of_child = parent[child]
        parent[child] = -1
        parent[centre] = -1
        active = active[~is_centre[active]]
        # Totals of the components of the children, found by their tops as these now stand.
        label = np.where(parent < 0, np.arange(len(parent)), parent)
        while True:
            higher = label[label]
            if np.array_equal(higher, label):
                break
            label = higher
        below = weights[centre].copy()
        number = np.zeros(len(parent), np.int64)
        number[centre] = np.arange(len(centre))
        for k in range(weights.shape[1]):
            sums = np.zeros(len(parent), np.int64)
            np.add.at(sums, label[active], weights[active, k])
            np.add.at(below[:, k], number[of_child], sums[child])
        total[centre] += below
        cut, at = size[centre], up
        while True:  # one path per component, so no node is met twice in a step
            on = at >= 0
            if not on.any():
                break
            at, cut, below = at[on], cut[on], below[on]
            total[at] += below
            size[at] -= cut
            at = parent[at]
    return total


TOTALS = "conv_id long, depth long, n_leaves long, saved_tokens long"


def _small(state: DataFrame) -> DataFrame:
    """Totals of components that one task can hold."""
    columns = ("conv_id", "depth", "parent_conv_id", "top_conv", "top_depth", "nodes", "leaf", "saved", "leaves_cut", "saved_cut")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows > _AT_ONCE:
                table = pa.Table.from_batches(held)
                a, b = table["top_conv"].to_numpy(), table["top_depth"].to_numpy()
                cut = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1]))
                if len(cut):
                    yield solve(table.slice(0, cut[-1] + 1))
                    held = table.slice(cut[-1] + 1).to_batches()
                    rows = sum(x.num_rows for x in held)
        if rows:
            yield solve(pa.Table.from_batches(held))

    def solve(table: pa.Table) -> pa.RecordBatch:
        c = {name: table[name].to_numpy(zero_copy_only=False) for name in columns if name != "parent_conv_id"}
        above = table["parent_conv_id"].fill_null(0).to_numpy()
        convs, number = np.unique(np.concatenate([c["conv_id"], above]), return_inverse=True)
        levels, level = np.unique(np.concatenate([c["depth"], c["depth"] - 1]), return_inverse=True)
        n = table.num_rows
        key = number * (len(levels) + 1) + level
        order = np.argsort(key[:n])
        at = np.searchsorted(key[:n][order], key[n:])
        parent = order[np.minimum(at, n - 1)]
        is_top = (c["conv_id"] == c["top_conv"]) & (c["depth"] == c["top_depth"])
        parent[is_top] = -1
        sums = decompose(parent, c["nodes"], np.stack([c["leaf"], c["saved"]], 1))
        out = (c["conv_id"], c["depth"], sums[:, 0] + c["leaves_cut"], sums[:, 1] + c["saved_cut"])
        return pa.RecordBatch.from_arrays([pa.array(x) for x in out], [x.split()[0] for x in TOTALS.split(", ")])

    near = state.repartition("top_conv", "top_depth").sortWithinPartitions("top_conv", "top_depth")
    return near.select(*columns).mapInArrow(finish, TOTALS)


def _cut(state: DataFrame, places: DataFrame, most_nodes: int) -> tuple[DataFrame, DataFrame] | None:
    """One round: each component with more than `most_nodes` nodes loses its centroid. Returns the totals of these, and what is left."""
    top = F.struct("top_conv", "top_depth").alias("top")
    large = state.where((F.col("conv_id") == F.col("top_conv")) & (F.col("depth") == F.col("top_depth")))
    large = written(large.where(F.col("nodes") > most_nodes).select(top, F.col("nodes").alias("whole")), "trie-large")
    if large.isEmpty():
        return None
    sized = left_join_spread(state.withColumn("top", top), large.withColumn("w", F.col("whole")), "top", "w", "conv_id")
    heavy = sized.where(2 * F.col("nodes") >= F.col("whole"))
    centre = heavy.groupBy("top", "whole").agg(F.min(F.struct("nodes", "depth", "conv_id")).alias("g"))
    centre = written(
        centre.select("top", "whole", F.col("g.conv_id").alias("g_conv"), F.col("g.depth").alias("g_depth"), F.col("g.nodes").alias("g_nodes")),
        "trie-centres",
    )
    marked = left_join_spread(state.withColumn("top", top), centre, "top", "whole", "conv_id")
    at = places.select(F.col("member").alias("conv_id"), F.col("depth").alias("g_depth"), "owner", "next")
    marked = marked.join(at, ["conv_id", "g_depth"], "left")
    below = (F.col("depth") >= F.col("g_depth")) & (F.col("owner") == F.col("g_conv"))
    marked = written(marked.withColumn("below", F.coalesce(below, F.lit(False))), "trie-marked")
    sums = marked.where("below").groupBy("top").agg(F.sum("leaf").alias("g_leaves"), F.sum("saved").alias("g_saved"))
    sums = written(centre.join(sums, "top"), "trie-sums")
    # From each centroid up to the top of its component, along the centroid's own path.
    upward = sums.join(places, F.col("g_conv") == F.col("member")).where("depth < g_depth AND depth >= top.top_depth")
    upward = upward.select(F.col("owner").alias("conv_id"), "depth", "g_nodes", "g_leaves", "g_saved")
    is_centre = (F.col("conv_id") == F.col("g_conv")) & (F.col("depth") == F.col("g_depth"))
    is_centre = F.coalesce(is_centre, F.lit(False))
    done = marked.where(is_centre).select("conv_id", "depth", "top", "leaves_cut", "saved_cut").join(sums, "top")
    done = done.select(
        "conv_id", "depth", (F.col("g_leaves") + F.col("leaves_cut")).alias("n_leaves"),
        (F.col("g_saved") + F.col("saved_cut")).alias("saved_tokens"),
    )
    rest = marked.where(~is_centre).drop("g_nodes").join(upward, ["conv_id", "depth"], "left")

    def moved(name: str, by: str, sign: int):
        return (F.col(name) + sign * F.coalesce(by, F.lit(0))).alias(name)

    rest = rest.select(
        "conv_id", "depth", "parent_conv_id",
        F.when(F.col("below"), F.col("next")).otherwise(F.col("top_conv")).alias("top_conv"),
        F.when(F.col("below"), F.col("g_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
        moved("nodes", "g_nodes", -1), "leaf", "saved", moved("leaves_cut", "g_leaves", 1), moved("saved_cut", "g_saved", 1),
    )
    return written(done, "trie-done"), written(rest, "trie-state")


def rolled_up(nodes: DataFrame, places: DataFrame, most_nodes: int) -> DataFrame:
    """`TOTALS`: leaves and saved tokens of each node's subtree. `nodes` has `n_children` too."""
    # The nodes below, for the first centroids: a conversation owns the end of its path.
    own = places.where("member = owner").groupBy("member").agg(F.min("depth").alias("from"), F.max("depth").alias("to"))
    own = own.withColumn("rows", F.col("to") + 1)
    each = left_join_spread(places.select("member", "depth", "owner"), own, "member", "rows", "depth")
    count = F.greatest(F.col("to") - F.greatest("from", "depth") + 1, F.lit(0))
    size = each.groupBy(F.col("owner").alias("conv_id"), "depth").agg(F.coalesce(F.sum(count), F.lit(0)).alias("nodes"))
    zero = F.lit(0).cast("long")
    root = nodes.where("depth = 0").agg(F.min("conv_id").alias("conv_id")).scalar()
    state = nodes.join(size, ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", root.alias("top_conv"), zero.alias("top_depth"), "nodes",
        (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
        zero.alias("leaves_cut"), zero.alias("saved_cut"),
    )
    state, done = written(state, "trie-state"), []
    while (cut := _cut(state, places, most_nodes)) is not None:
        done.append(cut[0])
        state = cut[1]
    return reduce(DataFrame.union, done, _small(state))


def ends(places: DataFrame, convs: DataFrame) -> DataFrame:
    """`conv_id, depth, ends_sha256` of nodes at which conversations end: one sorted pass that holds one hash."""

    def passes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, out = None, None, []
        for batch in batches:
            c, d, m = (batch[k].to_numpy() for k in ("conv_id", "depth", "member"))
            if not len(c):
                continue
            cut = np.flatnonzero((c[1:] != c[:-1]) | (d[1:] != d[:-1])) + 1
            for a, b in zip([0, *cut], [*cut, len(c)]):
                ids = ",".join(map(str, m[a:b].tolist())).encode()
                if (c[a], d[a]) == key:
                    digest.update(b"," + ids)
                    continue
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = (c[a], d[a]), hashlib.sha256(ids)
            yield rows(out)
            out = []
        if key is not None:
            yield rows([(*key, digest.hexdigest())])

    def rows(out: list[tuple]) -> pa.RecordBatch:
        c, d, h = zip(*out) if out else ((), (), ())
        columns = [pa.array(c, pa.int64()), pa.array(d, pa.int64()), pa.array(h, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "depth", "ends_sha256"])

    last = convs.select("member", F.col("length").alias("depth")).join(places, ["member", "depth"])
    near = last.select(F.col("owner").alias("conv_id"), "depth", "member")
    near = near.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "member")
    return near.mapInArrow(passes, "conv_id long, depth long, ends_sha256 string")


def summary(conversations: DataFrame, most_nodes: int = 50_000, **options) -> DataFrame:
    """Per node: `conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`."""
    nodes, places, convs = trie(conversations, **options)
    children = nodes.where("depth > 0").groupBy(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")
    ).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["conv_id", "depth"], "left")
    nodes = written(nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-children")
    totals = rolled_up(nodes, places, most_nodes)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    whole = nodes.join(totals, ["conv_id", "depth"]).join(ends(places, convs), ["conv_id", "depth"], "left")
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )
