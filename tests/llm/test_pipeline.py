"""The stages of the pipeline in a row, each against a plain version on its own input."""

from collections import Counter

import pytest

import corpus_pipeline
from adgleaner.llm import classifier, packing
from adgleaner.llm.common import written
from tests.conftest import DATA
from tests.llm.test_free import plain_components
from tests.llm.test_native import plain_found, plain_spans


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of each stage."""
    docs, out = spark.read.parquet(f"{DATA}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, DATA), f"test-{name}")
        out[name] = (docs, after)
        docs = after
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns(stages):
    for name, (before, after) in stages.items():
        assert name == "sequences" or after.columns == before.columns == list(corpus_pipeline.COLUMNS)


def test_quality(spark, stages):
    before, after = stages["quality"]
    model = classifier.fit(before, spark.read.parquet(f"{DATA}/labels.parquet"))
    rows = texts(before)
    odds = classifier.log_odds([t for _, t in rows], model)
    want = Counter(r for r, x in zip(rows, odds) if 1 / (1 + 2.718281828459045 ** -x) >= 0.3)
    assert Counter(texts(after)) == want and 0 < len(list(want.elements())) < len(rows)


def test_copies(stages):
    before, after = stages["copies"]
    rows = texts(before)
    want = {i for (i, _, least), _ in plain_components(rows).items() if i == least}
    assert {i for i, _ in texts(after)} == want and after.count() == len(want) < len(rows)


def test_benchmark(spark, stages):
    before, after = stages["benchmark"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    rows = texts(before)
    found = {i for i, _ in plain_found(rows, items)}
    assert found and Counter(texts(after)) == Counter(r for r in rows if r[0] not in found)


def test_personal(stages):
    before, after = stages["personal"]
    old, new = dict(texts(before)), dict(texts(after))
    assert old.keys() == new.keys()
    masked = [i for i in old if plain_spans(old[i] or "")]
    assert masked and not [i for i in new if plain_spans(new[i] or "")]
    assert all(old[i] == new[i] for i in old if i not in masked)


def test_sequences(stages):
    before, after = stages["sequences"]
    pieces = after.collect()
    length = Counter()
    for r in pieces:
        length[r.doc_id] += r.length
    assert length == Counter({i: len(t or "") for i, t in texts(before)})
    used = Counter()
    for r in pieces:
        used[r.bin_id, r.capacity] += r.length
    assert all(n <= capacity and capacity in packing.LENGTHS for (b, capacity), n in used.items() if b is not None)


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, DATA)
    want = stages["sequences"][1]
    key = lambda df: Counter((r.doc_id, r.start, r.length) for r in df.collect())
    assert key(got) == key(want)
