"""Readers. All give an explicit schema, also when there is nothing to read."""

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from adgleaner import schema


def empty(spark: SparkSession, of: T.StructType) -> DataFrame:
    return spark.createDataFrame([], of)


def _or_empty(read, spark: SparkSession, of: T.StructType) -> DataFrame:
    """A missing folder is no error: there is nothing to do."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return empty(spark, of)
        raise


def read_crawl_files(spark: SparkSession, path: str, bad_lines: str = "fail") -> DataFrame:
    """`.deflate` files of one JSON record per line, below `path` (which may hold wildcards).

    `bad_lines="keep"` puts a line that is no record into `_corrupt_record`.
    """
    of = schema.RAW_PAGE
    mode = "FAILFAST"
    if bad_lines == "keep":
        of = T.StructType(of.fields + [T.StructField("_corrupt_record", T.StringType())])
        mode = "PERMISSIVE"
    reader = spark.read.schema(of).option("mode", mode).option("pathGlobFilter", "*.deflate")
    return _or_empty(lambda: reader.json(path), spark, of)


def read_crawl_runs(spark: SparkSession, root: str, crawler: str) -> DataFrame:
    """Crawl files of every run, `<root>/<run>/<crawler>/data_pages/`, with `run` and `output_prefix`."""
    of = T.StructType(
        schema.RAW_PAGE.fields
        + [T.StructField(c, T.StringType()) for c in ("source_file", "run", "crawler", "output_prefix")]
    )
    reader = spark.read.schema(schema.RAW_PAGE).option("mode", "FAILFAST").option("pathGlobFilter", "*.deflate")
    return _or_empty(
        lambda: with_origin(reader.json(f"{root.rstrip('/')}/*/{crawler}/data_pages/")), spark, of
    )


def with_origin(df: DataFrame) -> DataFrame:
    """Add the file each record comes from, and the run and crawler its path names."""
    path = F.col("_metadata.file_path")
    pattern = r"/([^/]+)/([^/]+)/data_pages/[^/]*$"
    named = df.select(
        *df.columns,
        path.alias("source_file"),
        F.regexp_extract(path, pattern, 1).alias("run"),
        F.regexp_extract(path, pattern, 2).alias("crawler"),
    )
    return named.withColumn("output_prefix", F.concat("crawler", F.lit("_"), "run", F.lit("/")))


def read_index_hits(spark: SparkSession, path: str) -> DataFrame:
    """Search hits, one JSON object per line."""
    reader = spark.read.schema(schema.INDEX_HIT).option("mode", "FAILFAST")
    return _or_empty(lambda: reader.json(path), spark, schema.INDEX_HIT)


def read_parquet(spark: SparkSession, path: str, of: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(of) if of is not None else spark.read
    if of is None:
        return reader.parquet(path)
    return _or_empty(lambda: reader.parquet(path), spark, of)


def read_csv(spark: SparkSession, path: str, of: T.StructType) -> DataFrame:
    """CSV with a header; a quoted text may run over lines."""
    reader = spark.read.schema(of).options(header=True, multiLine=True, escape='"')
    return _or_empty(lambda: reader.csv(path), spark, of)


def list_files(spark: SparkSession, path: str, pattern: str = "*", top: str | None = None) -> DataFrame:
    """Files below `path`, without reading them; `top` keeps those of one top folder."""
    of = T.StructType(
        [T.StructField("source_file", T.StringType()), T.StructField("length", T.LongType())]
    )
    where = f"{path.rstrip('/')}/{top}" if top else path
    reader = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=True)
    return _or_empty(
        lambda: reader.load(where).select(F.col("path").alias("source_file"), "length"), spark, of
    )


def read_images(spark: SparkSession, path: str, relative: bool = False) -> DataFrame:
    """Image bytes by path: as listed, or `relative` to the folder, as listings name it."""
    of = T.StructType(
        [T.StructField("path", T.StringType()), T.StructField("content", T.BinaryType())]
    )
    reader = spark.read.format("binaryFile").options(recursiveFileLookup=True)
    # The listed path has a scheme that the folder's name may lack.
    folder = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/", path).rstrip("/") + "/"
    name = F.substring_index("path", folder, -1) if relative else F.col("path")
    return _or_empty(lambda: reader.load(path).select(name.alias("path"), "content"), spark, of)
