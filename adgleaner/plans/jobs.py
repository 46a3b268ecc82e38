"""Jobs: crawl files to listings, an index to listings, listings to labelled listings.

Tables of a job, below its target folder:
  pages      pages with what was found on them, and their text key; one folder per batch
  images     one row per image fetched; one folder per batch
  listings   the result, made from all of `pages`; with `versioned`, one folder per version
Files are read in batches, but which page of a text and which row of a URL stays is
decided over all of them, once per run, so that it does not depend on the batches.
"""

import logging
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from adgleaner import schema
from adgleaner.operators import candidates as cd, classify as cl, counts, dedupe, images as im
from adgleaner.operators import listings as ls, pages as pg
from adgleaner.operators.shape import spread
from adgleaner.operators.word_vectors import WordVectors
from adgleaner.plans import versions
from adgleaner.plans.incremental import ListingState
from adgleaner.sources import index, readers, sinks
from adgleaner.streaming.crawl import stream_crawl_files
from adgleaner.streaming.windows import in_run, run_end, window_of


@dataclass(frozen=True)
class JobOptions:
    rules: DataFrame | None = None
    parse_partitions: int | None = None
    collapse: str = "row"
    # Keep listings up to date from the pages of each run (`plans.incremental`) instead of making them from all pages.
    incremental: bool = False
    # Listings in versions that a manifest puts in force at once (`plans.versions`) instead of one table replaced in place.
    versioned: bool = False
    https_images_only: bool = False
    fetch: Callable[[DataFrame], DataFrame] | None = None
    # When an image that failed is tried again: after `retry_wait`, then twice that, and so on, `most_tries` times in all.
    retry_wait: timedelta = timedelta(hours=1)
    most_tries: int = 5
    now: Callable[[], datetime] = lambda: datetime.now(timezone.utc)
    task: str | None = None
    column: str | None = None
    model: PipelineModel | None = None
    # Learnt word vectors for labels by similarity of texts (`word_vectors.learn`); hashed words without.
    vectors: WordVectors | None = None
    # For classification by text and image: the folder that image paths start from, and what makes a vector of an image.
    images: str | None = None
    extract: Callable[[bytes], list[float]] | None = None


def _finish(listings: DataFrame, target: str, batch: int, options: JobOptions) -> DataFrame:
    """Images and classification, both optional."""
    if options.https_images_only:
        listings = pg.with_https_image(listings)
    known = waiting = None
    now = options.now()
    tried = readers.read_parquet(listings.sparkSession, f"{target}/attempts", im.ATTEMPT)
    if options.fetch:
        waiting = im.not_due(tried, now, options.retry_wait, options.most_tries)
    if options.fetch and batch:
        earlier = sinks.read_batches(listings.sparkSession, f"{target}/images", schema.IMAGES, before=batch)
        # An image shown by several batches is listed by each of them.
        known = earlier.groupBy("image").agg(F.min("image_path").alias("image_path"))
    images = f"{target}/images/batch={batch}"
    listings = im.add_images(listings, options.fetch, images, known=known, waiting=waiting)
    if options.fetch:
        # Kept per run: a run that is done again tries only what is due by then.
        fetched = listings.sparkSession.read.parquet(images)
        fetched = fetched.withColumn("tried", F.coalesce("tried", F.lit(True))) if "tried" in fetched.columns else fetched
        sinks.write_batch(im.attempts(fetched, now), f"{target}/attempts", batch)
    if options.task == "multi-model" and options.extract:
        listings = _with_vectors(im.stored(listings, f"{target}/with-paths"), target, options)
    if options.task:
        listings = cl.classify(listings, options.task, options.column, options.model, options.vectors)
    return listings.drop("image_vector")


def _with_vectors(listings: DataFrame, target: str, options: JobOptions) -> DataFrame:
    """Listings with the vector of their stored image, as the model takes it; without an image, NULL."""
    files = readers.read_images(listings.sparkSession, options.images, relative=True)
    vectors = im.image_vectors(im.path_counts(listings), files, options.extract)
    joined = im.with_image_vectors(listings, im.stored(vectors, f"{target}/vectors"))
    # A stored image that gives no vector cannot be classified by one.
    known = joined.withColumn("image_path", F.when(F.col("image_vector").isNotNull(), F.col("image_path")))
    return cl.image_vectors(known, "image_vector", "image_vector")


def extract_batch(raw: DataFrame, target: str, batch: int, options: JobOptions) -> dict[str, int]:
    """Parse one batch of crawl records into `pages`. Running it again gives the same table.

    Returns how many records came in and how many could be decoded.
    """
    records, incoming = counts.observed(spread(raw, options.parse_partitions), f"records {batch}", records=F.count("*"))
    pages, readable = counts.observed(pg.decode_pages(records), f"pages {batch}", pages=F.count("*"))
    extracted = ls.extracted_pages(pg.read_pages(pages), options.rules, options.collapse)
    # One page per text of a batch is enough for the decision over all of them.
    sinks.write_batch(dedupe.first_texts(extracted), f"{target}/pages", batch)
    # Of files without a record the plan is empty, and nothing is observed.
    figures = {"records": 0, "pages": 0} if raw.isEmpty() else {**incoming.get, **readable.get}
    logging.info("batch %s: %s", batch, figures)
    return figures


def publish(spark: SparkSession, target: str, batch: int, options: JobOptions) -> None:
    """Make `listings` from all pages: one page per text, then one row per URL, in order of retrieval.

    A row lies in the folder of the batch that saw its URL first. The table is
    replaced as a whole; it can be made again from `pages` at any time. With
    `incremental`, only pages of batches that are not yet published are looked at,
    and all rows lie in the folder of the batch that published them. With `versioned`, the old
    table stays as it is, and a reader of `versions.read` meets either it or the new one, whole.
    """
    pages = spark.read.parquet(f"{target}/pages")
    if options.incremental:
        since = _published(spark, target, options)
        state = ListingState(spark, f"{target}/state", options.collapse)
        state.merge(pages.where(F.col("batch") > (-1 if since is None else since)), f"batch{batch}")
        finished = _finish(state.listings(), target, batch, options).withColumn("batch", F.lit(batch).cast("long"))
        _put_in_force(finished, target, batch, options)
        return
    fresh = dedupe.first_texts(pages).drop("batch")
    listings = ls.typed_listings(cd.collapse_pages(fresh, options.collapse))
    finished = _finish(listings, target, batch, options)
    first = pages.groupBy("url").agg(F.min("batch").alias("batch"))
    _put_in_force(finished.join(first, "url"), target, batch, options)


def _put_in_force(finished: DataFrame, target: str, batch: int, options: JobOptions) -> None:
    if not options.versioned:
        _replace_listings(im.stored(finished, f"{target}/finished"), target)
        return
    spark = finished.sparkSession
    last = versions.current(spark, target)
    version = last.version + 1 if last else 1
    finished.hint("rebalance").write.mode("overwrite").parquet(versions.listings_folder(target, version))
    versions.commit(spark, target, version, batch)


def _published(spark: SparkSession, target: str, options: JobOptions) -> int | None:
    """The last batch that the listings hold; NULL if there are none."""
    if options.versioned:
        last = versions.current(spark, target)
        return last.batch if last else None
    return _last_batch(spark, f"{target}/published")


def _lacks_images(spark: SparkSession, target: str, options: JobOptions) -> bool:
    """Whether the version in force was made without images that can be fetched now."""
    last = versions.current(spark, target) if options.versioned and options.fetch else None
    return last is not None and not last.has_image_path


def _replace_listings(placed: DataFrame, target: str) -> None:
    writer = placed.hint("rebalance", "batch").write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("batch").parquet(f"{target}/listings")


def run_batch(raw: DataFrame, target: str, batch: int, options: JobOptions) -> dict[str, int]:
    """One batch of crawl records, and the listings with it."""
    figures = extract_batch(raw, target, batch, options)
    publish(raw.sparkSession, target, batch, options)
    return figures


def crawl_job(
    spark: SparkSession,
    source: str,
    target: str,
    options: JobOptions = JobOptions(),
    files_per_batch: int = 1000,
    bad_lines: str = "fail",
) -> None:
    """Process all crawl files below `source` that no earlier run has processed.

    `files_per_batch` bounds what one batch reads; the result is the same for any.
    `bad_lines="drop"` passes over lines that are no records instead of failing.
    With `versioned`, listings that were made without images get them as soon as a run can fetch.
    """
    files = stream_crawl_files(spark, source, files_per_batch, bad_lines)
    done: list[int] = []

    def one(raw: DataFrame, n: int) -> None:
        extract_batch(raw, target, n, options)
        done.append(n)

    query = (
        files.writeStream.foreachBatch(one)
        .option("checkpointLocation", f"{target}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # Also after a run that ended between its last batch and its listings.
    last = done[-1] if done else _last_batch(spark, f"{target}/pages")
    behind = done or last != _published(spark, target, options) or _lacks_images(spark, target, options)
    if last is not None and behind:
        publish(spark, target, last, options)
        if not options.versioned:
            sinks.write_batch(spark.range(1), f"{target}/published", last)


def _last_batch(spark: SparkSession, path: str) -> int | None:
    """The number of a table's last batch; NULL if there is no table."""
    of = T.StructType([T.StructField("batch", T.LongType())])
    return readers.read_parquet(spark, path, of).agg(F.max("batch")).first()[0]


def _index_pages(hits: DataFrame, start: datetime, end: datetime, options: JobOptions) -> DataFrame:
    """One page per text of a time range, with its window."""
    page = pg.index_hits(hits).withColumn("at", F.to_timestamp("retrieved"))
    wanted = in_run(page, "at", start, end).where(~pg.has_phrase(F.col("text")))
    windowed = wanted.withColumn("window_start", window_of("at", start)["start"]).drop("at")
    return dedupe.first_texts(ls.extracted_pages(windowed, options.rules, options.collapse, keep=("window_start",)))


def _index_listings(pages: DataFrame, options: JobOptions) -> DataFrame:
    collapsed = cd.collapse_pages(pages, options.collapse, ("window_start", "url"))
    named = ls.typed_listings(collapsed, keep=("window_start",))
    return named.withColumns(sinks.date_names(F.col("window_start"))).drop("window_start", "file_stamp")


def index_listings(
    hits: DataFrame, start: datetime, end: datetime, options: JobOptions = JobOptions(collapse="fields")
) -> DataFrame:
    """Listings from search hits: one row per URL and window, all windows in one pass."""
    return _index_listings(_index_pages(hits, start, end, options), options)


def indexed_hits(spark: SparkSession, path: str, start: datetime, end: datetime) -> DataFrame:
    """Search hits of a run from a segment index; segments of other times are not opened."""
    return index.as_hits(index.read_index(spark, path, start, run_end(start, end)))


def index_job(
    hits: DataFrame, start: datetime, end: datetime, target: str, options: JobOptions = JobOptions(collapse="fields")
) -> None:
    """Write the listings of a time range, one folder per day, without texts that other runs have.

    A rerun replaces all that it wrote before.
    """
    spark, run = hits.sparkSession, f"{start:%Y%m%dT%H%M%S}"
    of_run = T.StructType([*sinks.SEEN.fields, T.StructField("run", T.StringType())])
    others = readers.read_parquet(spark, f"{target}/pages", of_run).where(F.col("run") != run)
    fresh = im.stored(dedupe.not_seen(_index_pages(hits, start, end, options), others), f"{target}/pages/run={run}")
    listings = _finish(_index_listings(fresh, options), target, int(start.timestamp()), options)
    named = listings.withColumn("folder", F.regexp_replace("image_folder", "/$", ""))
    writer = named.hint("rebalance", "folder").write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("folder").parquet(f"{target}/listings/run={run}")


def scoring_job(
    spark: SparkSession, source: str, target: str, task: str, column: str | None = None, model: PipelineModel | None = None
) -> None:
    """Classify the listing files of `source` that `target` has not got yet."""
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("source and target must differ")
    files = (
        spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 1000).parquet(source)
    )
    query = (
        files.writeStream.foreachBatch(
            lambda part, n: sinks.write_batch(cl.classify(part, task, column, model), f"{target}/listings", n) and None
        )
        .option("checkpointLocation", f"{target}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def repair_images(spark: SparkSession, target: str, batch: int, options: JobOptions) -> None:
    """Images and classification for a finished batch that was written without them."""
    table = spark.read.parquet(f"{target}/listings/batch={batch}")
    if "image_path" in table.columns:
        return
    work = im.stored(_finish(table, target, batch, options), f"{target}/repaired/batch={batch}")
    # Dynamic overwrite swaps the batch in when all of it is written.
    sinks.write_listings(work.withColumn("batch", F.lit(batch)), f"{target}/listings", ("batch",))


def kept_report(raw: DataFrame) -> DataFrame:
    """Per site: pages read and pages that pass the error filter."""
    pages = pg.read_pages(pg.decode_pages(raw))
    return counts.kept_counts(pages, "site", ~pg.is_error_text(F.col("text")))
