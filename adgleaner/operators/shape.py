"""Plan helpers shared by the operators."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def compute_once(df: DataFrame, keep: Sequence[str], **columns: Column) -> DataFrame:
    """Keep some columns and add computed ones that later filters must not compute again.

    A filter on a projected column is pushed below the projection together with
    the expression, which then runs twice per row. A generator over one struct
    yields the same rows, stays in whole-stage codegen, and stops that.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*[F.col(f"`{c}`") for c in keep], F.inline(F.array(row)))


def spread(scan: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal the rows of a file scan out to all cores if it has fewer partitions than that.

    Compressed crawl files cannot be split, so one large file would be parsed by
    one core. Parquet is split between row groups only, so a large file may hold all
    rows in one of many partitions: fewer files than cores count as too few partitions.
    A scan that is already wide passes through without a shuffle. If
    some files are far larger than others, ask for a number of partitions.
    """
    if partitions:
        return scan.repartition(partitions)
    cores, now = scan.sparkSession.sparkContext.defaultParallelism, scan.rdd.getNumPartitions()
    files = scan.inputFiles()
    narrow = now < cores or (len(files) < cores and any(f.endswith(".parquet") for f in files))
    return scan.repartition(max(cores, now)) if narrow else scan
