"""What the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adgleaner.session import shared_folder

# A word: a run of characters that are none of the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back.

    Cuts the lineage: what follows needs neither the inputs nor earlier shuffle
    files, so a lost executor costs no more than its running tasks.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of_bytes(spark: SparkSession, size: int = 4 << 20) -> Iterator[None]:
    """Within it, Arrow batches hold little more than so many bytes. For actions on texts: narrow rows still come by the thousand."""
    with _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", size):
        yield


@contextmanager
def _setting(spark: SparkSession, name: str, value: int) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _GAP), "")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
