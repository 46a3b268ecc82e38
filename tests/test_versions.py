"""Versions of listings: what a reader meets while a run writes, after one that failed, and after images were added."""

import pytest
from pyspark.sql import functions as F

from adgleaner.operators import images as im, rules as rl
from adgleaner.plans import jobs, versions
from adgleaner.sources import sinks
from checks import ads
from tests.conftest import DATA


def raw(spark):
    return ads.raw_pages(spark, DATA).drop("p", "variant", "crawl").limit(60)


def table(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("incremental", [False, True])
def test_a_run_that_fails_leaves_the_old_version(spark, tmp_path, monkeypatch, incremental):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rules, early = rl.rules_table(spark, ads.RULES), F.pmod(F.xxhash64("url"), F.lit(2)) == 0
    every_image_fails = lambda images: images.select("image", "image_id", "n_rows", F.lit(None).cast("string").alias("image_path"))
    options = jobs.JobOptions(rules=rules, versioned=True, incremental=incremental, fetch=every_image_fails)
    with pytest.raises(ValueError, match="no version yet"):
        versions.read(spark, target)
    records = im.stored(raw(spark), str(tmp_path / "raw"))
    sinks.write_jsonl(records.where(early), f"{source}/one", "deflate")
    jobs.crawl_job(spark, f"{source}/*", target, options)
    old, old_pages, old_images = (table(versions.read(spark, target, t)) for t in ("listings", "pages", "images"))
    opened = versions.read(spark, target)

    # It fails between the tables: pages, images and listings are written, the manifest is not.
    sinks.write_jsonl(records.where(~early), f"{source}/two", "deflate")
    commit = versions.commit

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(versions, "commit", fail)
    with pytest.raises(RuntimeError, match="lost"):
        jobs.crawl_job(spark, f"{source}/*", target, options)
    assert spark.read.parquet(f"{target}/pages").count() > len(old_pages)
    assert [table(versions.read(spark, target, t)) for t in ("listings", "pages", "images")] == [old, old_pages, old_images]

    # The next run finds no new files and still finishes what the failed one began.
    monkeypatch.setattr(versions, "commit", commit)
    jobs.crawl_job(spark, f"{source}/*", target, options)
    assert versions.current(spark, target).version == 2
    both = str(tmp_path / "both")
    jobs.crawl_job(spark, f"{source}/*", both, options)
    assert table(versions.read(spark, target).drop("batch")) == table(versions.read(spark, both).drop("batch"))
    # Who read the old version still does, by name too; a run without news makes no version.
    assert table(opened) == table(versions.read(spark, target, version=1)) == old
    jobs.crawl_job(spark, f"{source}/*", target, options)
    assert versions.current(spark, target).version == 2


def test_images_are_added_by_the_first_run_that_can_fetch(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    sinks.write_jsonl(raw(spark), source, "deflate")
    fetch = lambda images: images.select("image", "image_id", "n_rows", F.concat(F.lit("x/"), "image_id").alias("image_path"))
    for f in (None, None, fetch, fetch):
        jobs.crawl_job(spark, source, target, jobs.JobOptions(versioned=True, fetch=f))
    assert [(r.version, r.has_image_path) for r in versions.manifests(spark, target).orderBy("version").collect()] == [(1, False), (2, True)]
    got = versions.read(spark, target)
    assert got.where("(image IS NULL) <> (image_path IS NULL)").isEmpty() and not got.where("image_path IS NOT NULL").isEmpty()
    with pytest.raises(ValueError, match="no such version"):
        versions.read(spark, target, version=9)
    with pytest.raises(ValueError, match="no table"):
        versions.read(spark, target, "prices")


def test_files_without_records(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    sinks.write_jsonl(raw(spark).where("false").coalesce(1), f"{source}/one", "deflate")
    sinks.write_jsonl(raw(spark).where("fetch_time % 2 = 0"), f"{source}/two", "deflate")
    jobs.crawl_job(spark, f"{source}/*", target, jobs.JobOptions(versioned=True))
    assert versions.read(spark, target).isEmpty() and "image" in versions.read(spark, target).columns
