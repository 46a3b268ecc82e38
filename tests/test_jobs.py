"""Readers, writers, streams and whole jobs on files."""

import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from adgleaner import schema
from adgleaner.operators import dedupe, images as im, listings as ls, pages as pg, rules as rl
from adgleaner.plans import jobs
from adgleaner.sources import readers, sinks
from adgleaner.streaming import crawl, windows
from checks import ads, queries
from tests.conftest import DATA


def raw(spark):
    return ads.raw_pages(spark, DATA).drop("p", "variant", "crawl")


def table(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_deflate_files(spark, tmp_path):
    folder = str(tmp_path / "crawl")
    sinks.write_jsonl(raw(spark), folder, "deflate")
    (tmp_path / "crawl" / "note.txt").write_text("not a crawl file")
    assert table(readers.read_crawl_files(spark, folder)) == table(raw(spark))
    names = readers.list_files(spark, folder, "*.deflate")
    assert names.count() > 0 and names.where(~F.col("source_file").endswith(".deflate")).count() == 0


def test_missing_folder_is_empty(spark, tmp_path):
    missing = str(tmp_path / "none")
    assert readers.read_crawl_files(spark, missing).schema == schema.RAW_PAGE
    assert readers.read_crawl_files(spark, missing).isEmpty()
    assert readers.read_crawl_runs(spark, missing, "x").isEmpty()
    assert readers.list_files(spark, missing).isEmpty()
    assert readers.read_index_hits(spark, missing).columns == ["_source"]


def test_bad_lines_fail_or_are_kept(spark, tmp_path):
    import zlib

    (tmp_path / "a.deflate").write_bytes(zlib.compress(b'{"url":"u","content":"YQ==","content_type":"t","fetch_time":1}\nbad\n'))
    kept = readers.read_crawl_files(spark, str(tmp_path), bad_lines="keep")
    assert sorted((r.url, r._corrupt_record) for r in kept.collect() if r.url) == [("u", None)]
    assert [r._corrupt_record for r in kept.collect() if not r.url] == ["bad"]
    with pytest.raises(Exception, match="FAILFAST|Malformed|MALFORMED"):
        readers.read_crawl_files(spark, str(tmp_path)).collect()


def test_runs(spark, tmp_path):
    for run in ("r1", "r2"):
        sinks.write_jsonl(raw(spark).limit(3), str(tmp_path / run / "shops" / "data_pages"), "deflate")
        sinks.write_jsonl(raw(spark).limit(3), str(tmp_path / run / "other" / "data_pages"), "deflate")
    got = readers.read_crawl_runs(spark, str(tmp_path), "shops")
    assert {(r.run, r.crawler, r.output_prefix) for r in got.collect()} == {
        ("r1", "shops", "shops_r1/"), ("r2", "shops", "shops_r2/"),
    }


def test_csv_keeps_line_breaks_and_quotes(spark, tmp_path):
    rows = spark.createDataFrame([('a\n"b", c', 1.5, "x"), (None, None, "y")], "t string, price double, k string")
    sinks.write_csv(rows, str(tmp_path / "csv"))
    assert table(readers.read_csv(spark, str(tmp_path / "csv"), rows.schema)) == table(rows)


def test_index_hits_file(spark, tmp_path):
    hits = queries._index_hits(spark, DATA)
    sinks.write_jsonl(hits, str(tmp_path / "hits"))
    again = readers.read_index_hits(spark, str(tmp_path / "hits"))
    assert table(again.select("_source.url", "_source.text")) == table(hits.select("_source.url", "_source.text"))


def test_images_from_files(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"one")
    got = readers.read_images(spark, str(tmp_path)).collect()
    assert [(r.path.rsplit("/", 1)[1], bytes(r.content)) for r in got] == [("a.png", b"one")]


def test_only_written_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    both = spark.createDataFrame([("a", 1), ("b", 2)], "source_file string, x int")
    sinks.write_listings(both, path, ("source_file",))
    sinks.write_listings(both.where("x = 2").withColumn("x", F.lit(3)), path, ("source_file",))
    assert sorted((r.source_file, r.x) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 3)]


def test_date_names(spark):
    names = sinks.date_names(F.lit(datetime(2024, 3, 7, 5, 6, 7)))
    got = spark.range(1).select(*[c.alias(n) for n, c in names.items()]).first()
    assert tuple(got) == ("data_Mar_07/", "images-mar", "data_Mar_07/data_03-07-2024T05:06:07")


def test_crawl_job_reads_each_file_once_and_remembers_texts(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    options = jobs.JobOptions(rules=rl.rules_table(spark, ads.RULES))
    sinks.write_jsonl(raw(spark), f"{source}/one", "deflate")
    jobs.crawl_job(spark, f"{source}/*", target, options)
    first = spark.read.parquet(f"{target}/listings")
    assert table(first.drop("batch")) == table(ls.listings_from_raw(raw(spark), rules=options.rules))

    jobs.crawl_job(spark, f"{source}/*", target, options)
    assert table(spark.read.parquet(f"{target}/listings")) == table(first)

    # A second crawl: the old pages again, and one new page.
    new = raw(spark).limit(1).select(
        F.lit("https://new.example.com/").alias("url"), F.base64(F.lit("<title>new</title>").cast("binary")).alias("content"),
        "content_type", "fetch_time",
    )
    sinks.write_jsonl(raw(spark).unionByName(new), f"{source}/two", "deflate")
    jobs.crawl_job(spark, f"{source}/*", target, options)
    added = spark.read.parquet(f"{target}/listings").where("batch > 0")
    assert [r.url for r in added.collect()] == ["https://new.example.com/"]


def test_a_batch_that_runs_again_leaves_the_same_tables(spark, tmp_path):
    target = str(tmp_path)
    bad = raw(spark).limit(1).withColumn("content", F.lit("!!"))
    records = raw(spark).unionByName(bad)
    for _ in range(2):
        figures = jobs.run_batch(records, target, 0, jobs.JobOptions(collapse="fields"))
        assert figures["records"] == records.count() == figures["pages"] + 1
        got = {t: table(spark.read.parquet(f"{target}/{t}")) for t in ("pages", "listings")}
        expected = got if _ == 0 else expected
    assert got == expected and len(got["listings"]) > 100


def test_repair_adds_images_once(spark, tmp_path):
    target = str(tmp_path)
    jobs.run_batch(raw(spark), target, 0, jobs.JobOptions())
    store = spark.read.parquet(f"{target}/listings").where("image IS NOT NULL").select(
        "image", F.lit(b"x").alias("content")
    ).distinct()
    options = jobs.JobOptions(fetch=im.fetch_from_table(store, "imgs"))
    jobs.repair_images(spark, target, 0, options)
    repaired = spark.read.parquet(f"{target}/listings/batch=0")
    assert repaired.where("image IS NOT NULL AND image_path IS NULL").count() == 0
    assert repaired.where("image_path IS NOT NULL").count() > 0
    jobs.repair_images(spark, target, 0, options)
    assert table(spark.read.parquet(f"{target}/listings/batch=0")) == table(repaired)


def test_job_with_images_https_filter_and_classes(spark, tmp_path):
    target = str(tmp_path)
    store = spark.createDataFrame([], "image string, content binary")
    options = jobs.JobOptions(
        https_images_only=True, fetch=im.fetch_from_table(store, "imgs"), task="zero-shot-classification"
    )
    jobs.run_batch(raw(spark), target, 0, options)
    out = spark.read.parquet(f"{target}/listings")
    assert out.where("image LIKE '%https%' AND image_path IS NULL AND label_product IS NOT NULL").count() == out.count() > 0


def test_an_image_of_an_earlier_batch_is_not_fetched_again(spark, tmp_path):
    target, log = str(tmp_path / "out"), str(tmp_path / "log")

    def load(address):
        with open(log, "a") as f:
            f.write(address + "\n")
        return b"x"

    def pages(name):
        html = '<title>{}</title><meta property="og:image" content="https://i/{}.png">'
        rows = [(f"http://x/{name}{i}", html.format(f"{name} {i}", i % 2 if i < 4 else name), 1000 + i) for i in range(5)]
        df = spark.createDataFrame(rows, "url string, html string, fetch_time long")
        return df.select("url", F.base64(F.encode("html", "UTF-8")).alias("content"), F.lit("text/html").alias("content_type"), "fetch_time")

    options = jobs.JobOptions(fetch=im.fetch_with(load, lambda path, data: None, "imgs"))
    for batch, name in enumerate(("a", "b", "c")):
        jobs.run_batch(pages(name), target, batch, options)
    assert sorted(open(log).read().split()) == [f"https://i/{n}.png" for n in ("0", "1", "a", "b", "c")]
    out = spark.read.parquet(f"{target}/listings")
    assert out.count() == 15 and out.where("image_path IS NULL").count() == 0
    assert out.where("image LIKE '%/0.png'").select("image_path").distinct().count() == 1


def test_images_are_fetched_by_many_tasks(spark):
    def load(address):
        if address.endswith("7"):
            raise OSError(address)
        return b"x"

    rows = spark.range(2000).select(
        F.concat(F.lit("https://i/"), F.col("id").cast("string")).alias("image"), F.col("id").cast("string").alias("id")
    )
    fetched = im.fetch_with(load, lambda path, data: None, "imgs", tasks=6)(im.distinct_images(rows))
    assert fetched.rdd.getNumPartitions() == 6
    assert fetched.where("image_path IS NULL").count() == 200 and fetched.count() == 2000


def test_job_with_text_and_image_classes(spark, tmp_path):
    """Fetch, vectors of the stored images, and labels, all within the job."""
    from adgleaner.operators import classify as cl

    store, target = str(tmp_path / "store"), str(tmp_path / "out")

    def save(path, data):
        import os

        os.makedirs(os.path.dirname(f"{store}/{path}"), exist_ok=True)
        with open(f"{store}/{path}", "wb") as f:
            f.write(data)

    rows = [(f"good thing {i}", [1.0, 0.0], 1) for i in range(10)] + [(f"bad thing {i}", [0.0, 1.0], 0) for i in range(10)]
    train = cl.image_vectors(spark.createDataFrame(rows, "product string, v array<double>, y int"), "v", "image_vector")
    model = cl.train_text_image_model(train, "product", "image_vector", 2, "y")
    options = jobs.JobOptions(
        fetch=im.fetch_with(lambda address: address.encode(), save, "imgs"), task="multi-model", model=model,
        images=store, extract=lambda data: [float(len(data) % 2), 1.0],
    )
    sinks.write_jsonl(raw(spark), str(tmp_path / "in"), "deflate")
    jobs.crawl_job(spark, str(tmp_path / "in"), target, options)
    out = spark.read.parquet(f"{target}/listings")
    assert out.count() > 50 and out.where("predicted_label IS NULL OR image_path IS NULL").count() == 0


def test_manifest_of_finished_files(spark, tmp_path):
    files = spark.createDataFrame([("a",), ("b",)], "source_file string")
    path = str(tmp_path / "manifest")
    for _ in range(2):
        sinks.mark_done(files.where("source_file = 'a'"), path, 0, has_image_path=False)
    manifest = sinks.read_batches(spark, path, sinks.MANIFEST)
    pending, repair = dedupe.split_by_manifest(files, manifest)
    assert [r[0] for r in pending.collect()] == ["b"] and [r[0] for r in repair.collect()] == ["a"]


def test_image_vectors_are_read_once_per_image(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(bytes([1, 2, 3]))
    files = readers.read_images(spark, str(tmp_path))
    path = files.first().path
    rows = spark.createDataFrame([(f"i{n}", path) for n in range(5)] + [("x", None), ("y", "missing")], "id string, image_path string")
    vectors = im.image_vectors(im.path_counts(rows), files, lambda b: [float(len(b)), float(sum(b))])
    got = {r.id: r.image_vector for r in im.with_image_vectors(rows, vectors).collect()}
    assert got == {**{f"i{n}": [3.0, 6.0] for n in range(5)}, "x": None, "y": None}


def test_index_job(spark, tmp_path):
    hits = queries._index_hits(spark, DATA)
    options = jobs.JobOptions(collapse="fields", rules=rl.rules_table(spark, ads.RULES))
    start, end = datetime(2023, 2, 10, 17, 0), datetime(2023, 2, 11, 21, 0)
    for _ in range(2):
        jobs.index_job(hits, start, end, str(tmp_path), options)
        out = spark.read.parquet(f"{tmp_path}/listings")
        assert {r.folder for r in out.select("folder").distinct().collect()} == {"data_Feb_10", "data_Feb_11"}
        assert out.count() == jobs.index_listings(hits, start, end, options).count() > 0


def test_scoring_job_skips_what_is_done(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.createDataFrame([("a toy", None, "d"), (None, None, None)], "title string, name string, description string")
    rows.write.parquet(source)
    for _ in range(2):
        jobs.scoring_job(spark, source, target, "zero-shot-classification")
        assert [r.label_product for r in spark.read.parquet(f"{target}/listings").collect()] == ["a toy"]
    with pytest.raises(ValueError):
        jobs.scoring_job(spark, source, source, "zero-shot-classification")


def test_stream_windows_equal_batch_windows(spark, tmp_path):
    events = spark.read.parquet(f"{DATA}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    source = str(tmp_path / "events")
    events.repartition(4).write.parquet(source)
    start, end = datetime(2024, 1, 3, 1, 30), datetime(2024, 1, 20, 12, 0)
    stream = spark.readStream.schema(events.schema).parquet(source)
    query = (
        windows.window_counts(stream, "ts", start, end, late="40 days")
        .writeStream.format("memory").queryName("windows").outputMode("complete").start()
    )
    query.processAllAvailable()
    query.stop()
    exact = lambda df: sorted((r.window_start, r.window_end, r.n_rows, round(r.sum_value, 4)) for r in df.collect())
    assert exact(spark.table("windows")) == exact(windows.window_counts(events, "ts", start, end))


def test_stream_keeps_one_page_per_text(spark, tmp_path):
    source = str(tmp_path / "in")
    sinks.write_jsonl(raw(spark).repartition(3), source, "deflate")
    pages = pg.admit(pg.read_pages(pg.decode_pages(crawl.stream_crawl_files(spark, source, files_per_batch=1))))
    query = (
        crawl.first_texts_stream(pages, "30 days").select("text_key")
        .writeStream.format("memory").queryName("texts").outputMode("append").start()
    )
    query.processAllAvailable()
    query.stop()
    batch = dedupe.first_texts(pg.admit(pg.read_pages(pg.decode_pages(raw(spark)))))
    assert table(spark.table("texts")) == table(batch.select("text_key"))


def test_loads_that_hang_do_not_drop_other_addresses(spark):
    def load(address):
        if address.startswith("dead"):
            time.sleep(20)
        return b"x"

    rows = spark.createDataFrame([(f"{k}{i}", f"{k}{i}") for k in ("dead", "fine") for i in range(6)], "id string, image string")
    fetch = im.fetch_with(load, lambda path, data: None, "imgs", tasks=1, threads=2, timeout=0.5)
    got = {r.image: r.image_path for r in fetch(im.distinct_images(rows)).collect()}
    assert got == {f"{k}{i}": f"imgs/{k}{i}.png" if k == "fine" else None for k in ("dead", "fine") for i in range(6)}
