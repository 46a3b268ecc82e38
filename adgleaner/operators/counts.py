"""Row counts per group and per run."""

from pyspark.sql import Column, DataFrame, Observation, functions as F


def kept_counts(df: DataFrame, by: str, kept: Column) -> DataFrame:
    """Rows and kept rows per group."""
    return df.groupBy(by).agg(
        F.count("*").alias("raw_rows"), F.count_if(kept).alias("kept_rows")
    )


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Count while the job runs; read the figures from the observation afterwards."""
    watch = Observation(name)
    return df.observe(watch, *[m.alias(k) for k, m in metrics.items()]), watch
