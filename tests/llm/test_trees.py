"""Earlier passages, the prefix trie and ranked search against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adgleaner.llm import mask_search, prefix_trees, prefix_trie, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_word_hashes_tell_words_apart():
    thue = "a"
    while len(thue) < 1024:
        thue += thue.translate(str.maketrans("ab", "ba"))
    some = ["", "a", "a\0", "ab", "abcdefgh", "abcdefgh\0", "abcdefghi", "é", "x" * 5000, "x" * 5001, thue, thue.translate(str.maketrans("ab", "ba"))]
    words = [w for w in some if w] + [f"w{i}" for i in range(5000)]
    data, offsets = tokens.text_bytes(pa.array([" ".join(words), "", "a b"]))
    first, end, of = tokens.word_places(data, offsets, ~tokens.BLANK)
    assert [bytes(data[a:b]).decode() for a, b in zip(first, end)] == words + ["a", "b"]
    assert list(of) == [0] * len(words) + [2, 2]
    h = tokens.word_hashes(data, first, end)
    assert len(set(h[:-2])) == len(words) and h[-2] == h[words.index("a")]


def test_words_of_neighbouring_texts_do_not_join():
    data, offsets = tokens.text_bytes(pa.array(["one two", "three", "", "four "]).slice(1))
    first, end, of = tokens.word_places(data, offsets, ~tokens.BLANK)
    assert [bytes(data[a:b]) for a, b in zip(first, end)] == [b"three", b"four"] and list(of) == [0, 2]


# Earlier passages


def plain_passages(rows, length):
    least = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - length + 1):
            key = tuple(w[k : k + length])
            if i is not None:
                least[key] = min(least.get(key, i), i)
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if i is not None and least[tuple(w[k : k + length])] < i:
                gone[k : k + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), kept))
    return Counter(out)


@pytest.fixture(scope="module")
def passages(spark, hard):
    rng = random.Random(5)
    shared = [" ".join(rng.choices("ab cd efé g".split(), k=n)) for n in (31, 32, 49, 50, 51, 80, 200)]
    extra = []
    for i in range(80):
        noise = [" ".join(f"n{rng.randrange(10**6)}" for _ in range(rng.randrange(30))) for _ in range(3)]
        gap = rng.choice([" ", "\n", "\t  "])
        extra.append((1000 + i, gap.join([noise[0], rng.choice(shared), noise[1], rng.choice(shared)[rng.randrange(9) :], noise[2]])))
    extra += [(2000, "a " * 300), (2001, "a " * 90), (2002, "a b " * 120), (1000, extra[3][1]), extra[5]]
    cut = hard.select("doc_id", F.substring("text", 1, 3000).alias("text"), F.lit("clash").alias("anchor"), F.lit(1).alias("owner"))
    more = spark.createDataFrame([(*r, "x", 2) for r in extra], "doc_id long, text string, anchor string, owner int")
    return cut.union(more).repartition(4).cache()


@pytest.mark.parametrize("length, most", [(50, 2000), (50, 1), (32, 2), (40, 2000)])
def test_earlier_passages(passages, length, most):
    got = prefix_trees.removed(passages, length, most_contexts=most).collect()
    rows = [(r.doc_id, r.text) for r in passages.collect()]
    assert Counter(map(tuple, got)) == plain_passages(rows, length)


def test_earlier_passages_name_where_they_come_from(spark):
    text = " ".join(f"w{i}" for i in range(70))
    docs = spark.createDataFrame([(1, "head " + text), (5, text + " tail"), (9, "x y " + text)], "doc_id long, text string")
    got = {tuple(r) for r in prefix_trees.repeats(docs).select("doc_id", "first", "words", "owner").collect()}
    covered = defaultdict(set)
    for doc, first, words, owner in got:
        assert owner == 1
        covered[doc] |= set(range(first, first + words))
    assert covered == {5: set(range(70)), 9: set(range(2, 72))}


def test_earlier_passages_of_hard_and_empty(hard, empty, hard_rows):
    got = prefix_trees.removed(hard).collect()
    assert len(got) == len(hard_rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[8].n_removed == 80 and by_id[7].n_removed == 0 and by_id[20].n_removed > 20_000
    assert prefix_trees.removed(empty).collect() == []


def test_long_texts_go_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trees, "_PIECE", 64)
    rng = random.Random(1)
    base = [f"w{rng.randrange(500)}" for _ in range(900)]
    rows = [(1, " ".join(base)), (2, " ".join(base[333:777])), (3, " ".join(base[5:54])), (4, " ".join(base[5:56]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, prefix_trees.removed(docs).collect())) == plain_passages(rows, 50)


def test_subtree_orders_leaves_and_finds_branches():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 2, 400)
    starts = np.arange(400 - 40)
    leaves, branch = prefix_trees.subtree(ids, starts, 40)
    strings = [tuple(ids[i : i + 40]) for i in leaves]
    assert strings == sorted(strings)
    for a, b, depth in zip(strings, strings[1:], branch[1:]):
        assert depth == next((k for k in range(40) if a[k] != b[k]), 40)


# Prefix trie


def plain_trie(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append(((turn is not None, turn or 0), role or "", text or ""))
    whole = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        base = sorted(turns.get(c - c % 100, []))[:h]
        whole[c] = [t[1:] for t in base + sorted(turns[c])[h:]]
    members = defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    name = {p: (min(m), len(p)) for p, m in members.items()}
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in sorted(members.items(), key=lambda x: -len(x[0])):
        leaves[p] += children[p] == 0
        if p:
            saved[p] += (len(m) - 1) * len(p[-1][1])
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    out = set()
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(p))
        parent = name[p[:-1]][0] if p else None
        out.add((*name[p], parent, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


@pytest.fixture(scope="module")
def talks(spark):
    rng = random.Random(2)
    rows = []
    for c in [*range(0, 340), 1234, 5000, 70001]:
        if c == 200:
            continue
        for turn in range(rng.randrange(1, 9)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["hi", "yes", "no", "a longer text", ""])))
    rows += [(7, None, "user", "first"), (7, None, None, None), (8, 3, "user", "tie"), (8, 3, "user", "tie"), (None, 1, "user", "x")]
    rows += [(c, k, "user", f"turn {k % 7}") for c in (400, 401, 402) for k in range(60)] + [(900, k, "user", "same") for k in range(1500)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.selectExpr("*", "'x' AS depth", "1 AS member", "'y' AS top", "2 AS nodes", "'z' AS owner", "3 AS pos").repartition(5).cache()


@pytest.mark.parametrize("most_nodes", [300, 50_000])
def test_prefix_trie(talks, most_nodes):
    got = prefix_trie.summary(talks, most_nodes).collect()
    rows = [tuple(r) for r in talks.select("conv_id", "turn", "role", "text").collect()]
    assert len(got) == len({(r.conv_id, r.depth) for r in got})
    assert {tuple(r) for r in got} == plain_trie(rows)


def test_prefix_trie_of_nothing_and_of_a_turnless_root(spark, talks):
    assert prefix_trie.summary(talks.limit(0)).collect() == []
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 1)
    alone = spark.createDataFrame([(c, 0, "user", "gone")], "conv_id long, turn long, role string, text string")
    got = [tuple(r) for r in prefix_trie.summary(alone).collect()]
    assert got == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_decompose_sums_subtrees_of_any_shape():
    rng = np.random.default_rng(0)
    shapes = [np.arange(-1, 3000), np.concatenate([[-1], np.zeros(500, int)]), np.array([-1, -1, -1])]
    shapes += [np.array([-1, *[rng.integers(max(0, i - w), i) for i in range(1, 800)]]) for w in (2, 30, 800)]
    for parent in shapes:
        w = rng.integers(0, 9, (len(parent), 2))
        want, size = w.copy(), np.ones(len(parent), np.int64)
        for i in range(len(parent) - 1, 0, -1):
            if parent[i] >= 0:
                want[parent[i]] += want[i]
                size[parent[i]] += size[i]
        assert np.array_equal(prefix_trie.decompose(parent, size, w), want)


# Ranked search


def plain_search(docs, items, k=20):
    texts = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    texts = [(i, ts, Counter(ts)) for i, ts in texts if ts]
    n, total = len(texts), sum(len(ts) for _, ts, _ in texts)
    df = Counter(t for _, _, c in texts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, ts, c in texts:
            m = 100 - 25 + 25 * len(ts) * n // total
            score = 0
            for t in TERM.findall((text or "").translate(LOWER)):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k])]
    return Counter(out)


@pytest.fixture(scope="module")
def asked(spark, hard_rows):
    rng = random.Random(4)
    words = ["base1", "one", "Two", "three", "à", "né", "passage5", "w1x1", "none", "x-y", "WORD", "base40", "tail"]
    texts = [None, "", "...", "absent words", "one", "one ONE one two", " ".join(f"base{i}" for i in range(90))]
    texts += [" ".join(rng.choices(words, k=rng.randrange(1, 12))) for _ in range(12)]
    texts.append(" ".join(f"w{i % 997}x{i}" for i in range(0, 60_000, 300)))
    return [(i, t) for i, t in enumerate(texts)] + [(None, "one two"), (4, "one")]


@pytest.mark.parametrize("k, most, block", [(20, 1_000_000, 8192), (3, 50, 4), (1, 1, 1)])
def test_search(spark, hard, hard_rows, asked, monkeypatch, k, most, block):
    monkeypatch.setattr(mask_search, "_BLOCK", block)
    items = spark.createDataFrame([(*a, "clash", 1) for a in asked], "item_id long, text string, h string, n int")
    got = mask_search.search(hard, items, k, most)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == plain_search(hard_rows, list(dict.fromkeys(asked)), k)


def test_search_of_nothing(spark, hard, empty, asked):
    items = spark.createDataFrame(asked, "item_id long, text string")
    assert mask_search.search(empty, items).collect() == []
    assert mask_search.search(hard, items.limit(0)).collect() == []


def test_search_does_not_score_groups_that_cannot_matter():
    rng = np.random.default_rng(1)
    n_terms, n = 12, 4000
    holds = rng.random((n, n_terms)) < np.linspace(0.9, 0.01, n_terms)
    row, terms = np.nonzero(holds)
    freq = rng.integers(1, 4, len(row))
    block = mask_search.Block(np.arange(n), rng.integers(80, 300, n), terms, freq, row, n_terms)
    weight = np.linspace(100, 5000, n_terms).astype(np.int64)
    rows, got, scored = block.best(np.arange(n_terms), weight, 20, 0)
    full = block.scores(np.arange(n), np.arange(n_terms), weight)
    assert sorted(got)[-20:] == sorted(full)[-20:] and scored < n / 10
