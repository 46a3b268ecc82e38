"""Versions of a job's tables: a manifest names what belongs together, and a new one replaces it at once.

A run writes its listings to a folder of their own and adds batches to the growing tables; nobody sees
any of it before the manifest of the new version is there, which is one small file. A reader keeps
the version it began with; a run that ends before its manifest leaves the last version in force, and
what it wrote is overwritten by the next one. Folders of old versions stay until somebody removes them.
One run at a time may write to a target.
"""

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from adgleaner.sources import readers

MANIFEST = T.StructType(
    [
        T.StructField("version", T.LongType()),
        # Last batch of the growing tables that belongs to the version.
        T.StructField("batch", T.LongType()),
        T.StructField("listings", T.StringType()),
        T.StructField("has_image_path", T.BooleanType()),
    ]
)
GROWING = ("pages", "images", "attempts")


def manifests(spark: SparkSession, target: str) -> DataFrame:
    """All versions of a target, one row each."""
    return readers.read_parquet(spark, f"{target}/manifest", MANIFEST).select(*MANIFEST.names)


def current(spark: SparkSession, target: str) -> Row | None:
    """The version in force; NULL if there is none yet."""
    return manifests(spark, target).orderBy(F.desc("version")).first()


def listings_folder(target: str, version: int) -> str:
    return f"{target}/versions/{version}/listings"


def commit(spark: SparkSession, target: str, version: int, batch: int) -> None:
    """Put a version in force. Its listings are written by then."""
    listings = listings_folder(target, version)
    has_path = "image_path" in spark.read.parquet(listings).columns
    row = spark.createDataFrame([(version, batch, listings, has_path)], MANIFEST)
    # One row is one file, which appears whole or not at all.
    row.coalesce(1).write.mode("overwrite").parquet(f"{target}/manifest/v={version}")


def read(spark: SparkSession, target: str, table: str = "listings", version: int | None = None) -> DataFrame:
    """A table of the version in force, or of a given one."""
    found = current(spark, target) if version is None else manifests(spark, target).where(F.col("version") == version).first()
    if found is None:
        raise ValueError(f"{target} has no such version" if version is not None else f"{target} has no version yet")
    if table == "listings":
        return spark.read.parquet(found.listings)
    if table not in GROWING:
        raise ValueError(f"no table {table!r}")
    return spark.read.parquet(f"{target}/{table}").where(F.col("batch") <= found.batch)
