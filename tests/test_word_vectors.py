"""Word vectors learnt from texts, and labels that share no word with a text."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from adgleaner.operators import classify as cl, shape, word_vectors as wv
from checks import queries as q
from tests.conftest import DATA

TEXTS = [(1, "A b a c."), (2, "b, B! a x"), (3, ""), (4, None), (5, "zz"), (6, "a b c " * 40), (7, "c c c")]


def test_pairs_and_information_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(wv, "_PIECE", 7)
    texts = spark.createDataFrame(TEXTS, "id int, text string")
    places = {"a": 0, "b": 1, "c": 2}
    expected = Counter()
    for _, t in TEXTS:
        ids = [places[w] for w in wv.words_of(t) if w in places]
        for i, first in enumerate(ids):
            for second in ids[i + 1 : i + 4]:
                expected[first, second] += 1
                expected[second, first] += 1
    pairs = wv._pair_counts(texts, "text", places, 3)
    assert {(r.a, r.b): r.n for r in pairs.collect()} == expected
    total = sum(expected.values())
    of = Counter()
    for (a, _), n in expected.items():
        of[a] += n
    values = {k: np.log(n * total / of[k[0]] / of[k[1]]) for k, n in expected.items()}
    got = {(r.a, b): v for r in wv._information(pairs).collect() for b, v in zip(r.bs, r["values"])}
    assert got == pytest.approx({k: v for k, v in values.items() if v > 0})


def test_decomposition_restores_the_matrix(spark):
    rng = np.random.default_rng(1)
    texts = [(" ".join(rng.choice(list("abcdef" if i % 2 else "efghij"), 12)),) for i in range(60)]
    df = spark.createDataFrame(texts, "text string")
    model = wv.learn(df, dims=10, least=1)
    frequent = wv._frequent_words(df, "text", 1, 100)
    assert tuple(w for w, _ in frequent) == model.words
    full = np.zeros((10, 10))
    for r in wv._information(wv._pair_counts(df, "text", model.places, 5)).collect():
        full[r.a, r.bs] = r["values"]
    # Singular vectors of a symmetric matrix: the product of the vectors with themselves is its absolute value.
    values, turned = np.linalg.eigh(full)
    assert np.allclose(model.vectors @ model.vectors.T, turned @ np.diag(np.abs(values)) @ turned.T, atol=1e-6)


def test_labels_share_no_word_with_the_text(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    first, again = ({r.doc_id: r for r in q.language_labels(docs).collect()} for _ in range(2))
    assert first == again
    unseen = [r for r in first.values() if r.doc_id % 2 and len(r.product) >= 200]
    assert not any("qq" in r.product for r in unseen)
    assert sum(r.label_product == f"qq{r.lang}" for r in unseen) >= 0.98 * len(unseen) > 50


def test_unknown_words(spark):
    texts = spark.createDataFrame(TEXTS, "id int, text string")
    model = wv.learn(texts, dims=2, least=2)
    assert model.words == ("c", "a", "b")
    got = cl.zero_shot_text(texts, "text", ("a", "B b"), vectors=model)
    assert {r.id for r in got.where(F.col("label_product").isNull()).collect()} == {3, 4, 5}
    with pytest.raises(ValueError, match="nothing"):
        cl.zero_shot_text(texts, "text", ("a", "nothing"), vectors=model)
    assert wv.learn(texts.limit(0)).words == ()
    alone = wv.learn(texts.where("id = 5"), least=1)
    assert alone.words == ("zz",) and alone.of("zz") is None


def test_pairs_of_parts_are_added_up_and_passed_on(spark, monkeypatch):
    monkeypatch.setattr(wv, "_HELD", 10)
    monkeypatch.setattr(wv, "_PAIRS_HELD", 4)
    texts = spark.createDataFrame([("a b a b c c " * 5,)] * 20, "text string").coalesce(1)
    places = {"a": 0, "b": 1, "c": 2}
    pairs = wv._pair_counts(texts, "text", places, 2)
    expected = Counter()
    ids = [places[w] for w in "a b a b c c".split() * 5]
    for i, first in enumerate(ids):
        for second in ids[i + 1 : i + 3]:
            expected[first, second] += 20
            expected[second, first] += 20
    assert {(r.a, r.b): r.n for r in pairs.collect()} == expected


def test_a_parquet_file_of_one_row_group_is_dealt_out(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    spark.range(20_000).coalesce(1).write.parquet(f"{tmp_path}/one")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        scan = spark.read.parquet(f"{tmp_path}/one")
        assert scan.rdd.getNumPartitions() >= cores
        rows = shape.spread(scan).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert len(rows) >= cores and sum(r["count"] for r in rows) == 20_000
    assert max(r["count"] for r in rows) < 20_000 / cores * 1.5
