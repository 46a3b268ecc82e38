"""The segment index: what a scan opens, and that it finds what a plain scan finds."""

from datetime import datetime, timedelta
from urllib.parse import urlparse

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from adgleaner import schema
from adgleaner.sources import index

START = datetime(2023, 2, 10)


@pytest.fixture
def hits(spark):
    rows = []
    for i in range(600):
        # A third at one moment.
        at = START + timedelta(hours=30 if i % 3 == 0 else i / 10)
        rows.append((f"https://a/{i}", f"t{i}", "text", "a", at.strftime("%Y-%m-%dT%H:%M:%S.000+0000"), None, "text/html"))
    rows += [("https://none", "t", "x", "a", None, None, ""), ("https://bad", "t", "x", "a", "no time", None, "")]
    return spark.createDataFrame([(r,) for r in rows], schema.INDEX_HIT)


def found(df):
    return sorted(r.url for r in df.select("url").collect())


def expected(hits, start, end):
    at = F.try_to_timestamp(F.col("_source.retrieved"))
    return sorted(r.url for r in hits.where((at >= F.lit(start)) & (at < F.lit(end))).select("_source.url").collect())


RANGES = [(0, 100), (5, 6), (29, 30), (30, 31), (30, 30), (100, 200), (59.9, 60)]


@pytest.mark.parametrize("by_filter", [False, True])
def test_scan_finds_what_a_plain_scan_finds(spark, hits, tmp_path, by_filter):
    index.write_index(hits, str(tmp_path), "a", segments=7, slice_bytes=1000)
    whole = index.read_index(spark, str(tmp_path), slice_rows=30)
    assert whole.count() == 600
    for a, b in RANGES:
        start, end = START + timedelta(hours=a), START + timedelta(hours=b)
        if by_filter:
            got = whole.where((F.col("at") >= F.lit(start)) & (F.col("at") < F.lit(end)))
        else:
            got = index.read_index(spark, str(tmp_path), start, end, slice_rows=30)
        assert found(got) == expected(hits, start, end)
    assert found(whole.where(F.col("at") == F.lit(START + timedelta(hours=30)))) == expected(hits, START + timedelta(hours=30), START + timedelta(hours=30, seconds=1))


def test_segments_beyond_the_range_are_never_opened(spark, hits, tmp_path):
    index.write_index(hits, str(tmp_path), "a", segments=8)
    start, end = START + timedelta(hours=10), START + timedelta(hours=20)
    want = expected(hits, start, end)
    bounds = pq.read_table(str(tmp_path / "bounds")).to_pylist()
    beyond = [b for b in bounds if b["last"] < index._micros(start) or b["first"] >= index._micros(end)]
    assert 0 < len(beyond) < len(bounds)
    for b in beyond:
        with open(urlparse(b["file"]).path, "wb") as f:
            f.write(b"no parquet file")
    assert found(index.read_index(spark, str(tmp_path), start, end)) == want
    at = F.col("at")
    filtered = index.read_index(spark, str(tmp_path)).where((at >= F.lit(start)) & (at < F.lit(end)) & (F.col("domain") == "a"))
    assert found(filtered) == want
    with pytest.raises(Exception, match="ArrowInvalid|Parquet"):
        index.read_index(spark, str(tmp_path)).count()


def test_columns_slices_and_loads(spark, hits, tmp_path):
    early = F.col("_source.retrieved") < "2023-02-11"
    for _ in range(2):  # a load that runs again replaces itself
        index.write_index(hits.where(early), str(tmp_path), "early", segments=2)
        index.write_index(hits.where(~early), str(tmp_path), "late", segments=2)
    got = index.read_index(spark, str(tmp_path), columns=("url",))
    assert got.columns == ["url"] and got.count() == 600
    reader = index.SegmentReader({"path": str(tmp_path), "slice_rows": "50"}, ["url"])
    assert len(reader.partitions()) > 4 and index.SegmentReader({"path": str(tmp_path), "end": "0"}, ["url"]).partitions() == []


def test_without_pushdown_the_range_given_still_counts(spark, hits, tmp_path):
    index.write_index(hits, str(tmp_path), "a", segments=3)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
    try:
        got = index.read_index(spark, str(tmp_path), START, START + timedelta(hours=9))
        assert found(got.where(F.col("at") >= F.lit(START + timedelta(hours=1)))) == expected(hits, START + timedelta(hours=1), START + timedelta(hours=9))
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
