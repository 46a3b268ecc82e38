"""Crawl files as a stream: each file is read once, across runs."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from adgleaner import schema


def stream_crawl_files(
    spark: SparkSession, path: str, files_per_batch: int = 1000, bad_lines: str = "fail"
) -> DataFrame:
    """New `.deflate` files below `path`; lines that are no records end the stream, or are dropped."""
    mode = {"fail": "FAILFAST", "drop": "DROPMALFORMED"}[bad_lines]
    return (
        spark.readStream.schema(schema.RAW_PAGE)
        .options(pathGlobFilter="*.deflate", maxFilesPerTrigger=files_per_batch, mode=mode)
        .json(path)
    )


def first_texts_stream(pages: DataFrame, late: str = "1 day") -> DataFrame:
    """One page per text while the stream runs. State is kept for `late` of event time;
    texts older than that are settled over all pages (`plans.jobs.publish`).

    Stream deduplication sends every row to the task that keeps its key. So that
    a text which many pages share does not flood one task, each Arrow batch is
    reduced first.
    """

    def first_in_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~batch.column("text_key").to_pandas().duplicated()))

    time = F.to_timestamp("retrieved", "yyyy-MM-dd'T'HH:mm:ss.SSSxx")
    timed = pages.withColumn("event_time", time)
    reduced = timed.mapInArrow(first_in_batch, timed.schema)
    return reduced.withWatermark("event_time", late).dropDuplicatesWithinWatermark(["text_key"])
