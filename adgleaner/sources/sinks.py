"""Writers. Each can run again without leaving a trace of the first run."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from adgleaner.sources.readers import read_parquet

SEEN = T.StructType([T.StructField("text_key", T.StringType())])
MANIFEST = T.StructType(
    [T.StructField("source_file", T.StringType()), T.StructField("has_image_path", T.BooleanType())]
)


def write_listings(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Parquet; only the partitions at hand are replaced.

    Rebalancing makes files of even size: a partition that holds much of the
    data is split over several tasks.
    """
    writer = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    writer.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, escape='"').csv(path)


def write_jsonl(df: DataFrame, path: str, compression: str = "none") -> None:
    df.write.mode("overwrite").option("compression", compression).json(path)


def date_names(ts: Column) -> dict[str, Column]:
    """Names a job derives from a date: image folder, image bucket, file stamp."""
    return {
        "image_folder": F.concat(F.lit("data_"), F.date_format(ts, "MMM_dd"), F.lit("/")),
        "image_bucket": F.concat(F.lit("images-"), F.lower(F.date_format(ts, "MMM"))),
        "file_stamp": F.concat(
            F.lit("data_"), F.date_format(ts, "MMM_dd"), F.lit("/data_"), F.date_format(ts, "MM-dd-yyyy'T'HH:mm:ss")
        ),
    }


def write_batch(df: DataFrame, path: str, batch: int) -> str:
    """One batch of a growing table, in its own folder; a batch that runs again replaces itself."""
    folder = f"{path.rstrip('/')}/batch={batch}"
    df.write.mode("overwrite").parquet(folder)
    return folder


def read_batches(spark: SparkSession, path: str, of: T.StructType, before: int | None = None) -> DataFrame:
    """A growing table, up to but not including batch `before`."""
    with_batch = T.StructType(of.fields + [T.StructField("batch", T.LongType())])
    table = read_parquet(spark, path, with_batch)
    return table if before is None else table.where(F.col("batch") < before)


def mark_done(files: DataFrame, path: str, batch: int, has_image_path: bool) -> str:
    """Record files as processed."""
    done = files.select("source_file", F.lit(has_image_path).alias("has_image_path"))
    return write_batch(done, path, batch)
