"""Images: fetch each distinct address once, and join the path back to all listings."""

from collections import deque
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta
from queue import Empty, SimpleQueue
from threading import Thread
from time import monotonic

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from adgleaner import schema
from adgleaner.functions import web
from adgleaner.operators.skew import left_join_spread


def distinct_images(listings: DataFrame) -> DataFrame:
    """One row per image with a representative id. Counted before the shuffle."""
    return (
        listings.where(F.col("image").isNotNull())
        .groupBy("image")
        .agg(F.min("id").alias("image_id"), F.count("*").alias("n_rows"))
    )


def image_file(folder: str, image_id: Column) -> Column:
    """Path of a stored image; an empty folder means the top."""
    prefix = f"{folder.rstrip('/')}/" if folder else ""
    return F.concat(F.lit(prefix), image_id, F.lit(".png"))


def fetch_from_table(store: DataFrame, folder: str) -> Callable[[DataFrame], DataFrame]:
    """Fetcher that finds images in a table (image, content), one row per image."""

    def fetch(images: DataFrame) -> DataFrame:
        found = store.select(F.col("image"), F.col("content").isNotNull().alias("found"))
        path = F.when(F.col("found"), image_file(folder, F.col("image_id")))
        return images.join(found, "image", "left").select("image", "image_id", "n_rows", path.alias("image_path"))

    return fetch


TRIED = T.StructType([*schema.IMAGES.fields, T.StructField("tried", T.BooleanType())])


def fetch_with(
    load: Callable[[str], bytes],
    save: Callable[[str, bytes], None],
    folder: str,
    exists: Callable[[str], bool] | None = None,
    tasks: int | None = None,
    threads: int = 8,
    timeout: float = 30.0,
    per_host: int = 4,
    give_up: int = 3,
) -> Callable[[DataFrame], DataFrame]:
    """Fetcher that calls `load(address)` and `save(path, bytes)` on the executors.

    A stored image is not loaded again; an address that fails, or that takes more
    than `timeout` seconds, gives a NULL path. The addresses of a host are dealt out over
    `per_host` lanes, and a lane lies in one task and loads one address after the other: no
    host has more loads at once than that, however many tasks there are, and a host that
    holds much of the work is spread over so many tasks. Lanes are dealt out to `tasks` tasks
    (by default, as many as shuffles have partitions) that are not merged by size; each task
    loads `threads` at a time. The time of a load counts from its own start, and one that hangs
    gives its place to the next address. After `give_up` in a row the rest of the lane is left
    untried (`tried` is false), so that a dead host holds no more threads than that.
    """

    def one(address: str, path: str) -> str | None:
        try:
            if exists is None or not exists(path):
                save(path, load(address))
            return path
        except Exception:
            return None

    def loaded(todo: list[tuple[str, str, str]], hung: dict[str, int]) -> list[tuple[str | None, bool]]:
        out: list[tuple[str | None, bool]] = [(None, False)] * len(todo)
        lanes: dict[str, deque[int]] = {}
        for i, (lane, _, _) in enumerate(todo):
            lanes.setdefault(lane, deque()).append(i)
        free = deque(lane for lane in lanes if hung.get(lane, 0) < give_up)
        ready: SimpleQueue = SimpleQueue()
        limits: dict[int, float] = {}  # of the loads that run, the earliest first

        def run(i: int) -> None:
            ready.put((i, one(*todo[i][1:])))

        def done(i: int, path: str | None, late: bool) -> None:
            lane = todo[i][0]
            out[i] = (path, True)
            hung[lane] = hung.get(lane, 0) + 1 if late else 0
            if lanes[lane] and hung[lane] < give_up:
                free.append(lane)

        while True:
            while len(limits) < threads and free:
                i = lanes[free.popleft()].popleft()
                limits[i] = monotonic() + timeout
                # A load that hangs must not hold the task.
                Thread(target=run, args=(i,), daemon=True).start()
            if not limits:
                return out
            first = next(iter(limits))
            try:
                i, path = ready.get(timeout=max(limits[first] - monotonic(), 0))
            except Empty:
                del limits[first]
                done(first, None, True)
                continue
            if limits.pop(i, None) is not None:
                done(i, path, False)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hung: dict[str, int] = {}
        for batch in batches:
            got = loaded(list(zip(batch.pop("lane"), batch["image"], batch["image_path"])), hung)
            batch["image_path"], batch["tried"] = [g[0] for g in got], [g[1] for g in got]
            yield batch

    def fetch(images: DataFrame) -> DataFrame:
        path = image_file(folder, F.col("image_id")).alias("image_path")
        # An address that names no host stands for itself.
        host = F.coalesce(F.lower(web.domain(F.col("image"))), F.col("image"))
        lane = F.concat(F.pmod(F.xxhash64("image"), F.lit(per_host)), F.lit(" "), host).alias("lane")
        named = images.select("image", "image_id", "n_rows", path, lane)
        n = tasks or int(images.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return named.repartition(n, "lane").mapInPandas(each, TRIED)

    return fetch


ATTEMPT = T.StructType(
    [T.StructField("image", T.StringType()), T.StructField("tried_at", T.TimestampType()), T.StructField("found", T.BooleanType())]
)


def attempts(fetched: DataFrame, now: datetime) -> DataFrame:
    """What a run has tried, to be kept for the next."""
    tried = fetched.where("tried") if "tried" in fetched.columns else fetched
    return tried.select("image", F.lit(now).cast("timestamp").alias("tried_at"), F.col("image_path").isNotNull().alias("found"))


def not_due(tried: DataFrame, now: datetime, wait: timedelta, most_tries: int) -> DataFrame:
    """Images that failed and are not to be tried now: the wait doubles with each failure, and `most_tries` are enough."""
    per = tried.groupBy("image").agg(
        F.max("found").alias("found"), F.count("*").alias("tries"), F.max("tried_at").alias("last")
    )
    passed = F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds("last")
    soon = passed < F.lit(wait.total_seconds()) * F.pow(F.lit(2.0), F.col("tries") - 1)
    return per.where(~F.col("found") & (soon | (F.col("tries") >= most_tries))).select("image")


def image_vectors(
    paths: DataFrame, files: DataFrame, extract: Callable[[bytes], list[float]]
) -> DataFrame:
    """Feature vector per stored image: (image_path, n_rows, image_vector).

    `paths` has one row per image path with its number of listings, `files` is
    (path, content). Vectors are taken right at the scan of the files, so that no
    image moves; only they are joined.
    """

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["image_vector"] = [extract(c) for c in batch.pop("content")]
            yield batch

    content = files.select(F.col("path").alias("image_path"), "content")
    vectors = content.mapInPandas(each, "image_path string, image_vector array<double>")
    return paths.join(vectors, "image_path").select("image_path", "n_rows", "image_vector")


def with_image_vectors(listings: DataFrame, vectors: DataFrame) -> DataFrame:
    return left_join_spread(listings, vectors, "image_path", "n_rows", "id")


def path_counts(listings: DataFrame) -> DataFrame:
    """One row per image path with its number of listings."""
    return listings.where(F.col("image_path").isNotNull()).groupBy("image_path").agg(F.count("*").alias("n_rows"))


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back, so that what made it never runs again."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_images(listings: DataFrame, fetched: DataFrame, path_column: str = "image_path") -> DataFrame:
    """Left join of the image path; a listing without an image or a fetched one has NULL."""
    paths = fetched.select("image", "n_rows", F.col("image_path").alias(path_column))
    return left_join_spread(listings, paths, "image", "n_rows", "id")


def add_images(
    listings: DataFrame,
    fetch: Callable[[DataFrame], DataFrame] | None,
    manifest_path: str | None = None,
    path_column: str = "image_path",
    known: DataFrame | None = None,
    waiting: DataFrame | None = None,
) -> DataFrame:
    """The image step of a job; passes listings through if there is no fetcher.

    With `manifest_path` the fetched images are written there first. A fetcher
    with side effects needs that: the join reads its result more than once.
    Images that `known` has a path for are not fetched again, those of `waiting` not now.
    """
    if fetch is None:
        return listings
    images = distinct_images(listings)
    if waiting is not None:
        images = images.join(waiting, "image", "left_anti")
    if known is None:
        fetched = fetch(images)
    else:
        have = known.where(F.col("image_path").isNotNull()).select("image", "image_path")
        done = images.join(have, "image").select("image", "image_id", "n_rows", "image_path", F.lit(False).alias("tried"))
        fetched = fetch(images.join(have, "image", "left_anti")).unionByName(done, allowMissingColumns=True)
    return with_images(listings, stored(fetched, manifest_path) if manifest_path else fetched, path_column)
