"""First-occurrence dedupe and exclusion of what was seen before."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key.

    The limit on the rank lets Spark cut each group down to one row per task
    before the shuffle, so a key that holds a third of the rows sends one row
    per task, not all of them, to one place.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("turn", F.row_number().over(window)).where("turn = 1").drop("turn")


def first_texts(pages: DataFrame) -> DataFrame:
    """One page per normalised text: the one retrieved first, by URL on a tie."""
    return first_per(pages, ["text_key"], [F.col("retrieved"), F.col("url")])


def not_seen(pages: DataFrame, seen: DataFrame, key: str = "text_key") -> DataFrame:
    """Rows whose key the seen table does not hold. Dedupe first: then no key repeats."""
    return pages.join(seen.select(key), key, "left_anti")


def pending_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that were never processed."""
    return files.join(manifest.select("source_file"), "source_file", "left_anti")


def split_by_manifest(files: DataFrame, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files to process in full, finished files that still lack image paths)."""
    lacking = manifest.where(~F.col("has_image_path"))
    repair = files.join(lacking.select("source_file"), "source_file", "left_semi")
    return pending_files(files, manifest), repair


def listing_id(url: Column) -> Column:
    """Id that a rerun or a retried task gives again."""
    return F.sha2(url.cast("binary"), 256)


def random_id() -> Column:
    """A uuid. A retried task gives another one, so write the table before using it twice."""
    return F.uuid()


def row_number_id() -> Column:
    """A number per row, rising but with gaps. It depends on the partitions."""
    return F.monotonically_increasing_id()
