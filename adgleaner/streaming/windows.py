"""Consecutive half-open windows from a start time, on tables and on streams."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F

HOURS = 2


def _utc(t: datetime) -> datetime:
    return t if t.tzinfo else t.replace(tzinfo=timezone.utc)


def run_end(start: datetime, end: datetime, hours: int = HOURS) -> datetime:
    """End of the last window: windows begin until `end`, and the last may run past it."""
    step = timedelta(hours=hours)
    return start + step * -(-(end - start) // step)


def window_of(ts: str, start: datetime, hours: int = HOURS) -> Column:
    """The window a time falls in; windows are counted from `start`."""
    offset = int(_utc(start).timestamp()) % (hours * 3600)
    return F.window(ts, f"{hours} hours", f"{hours} hours", f"{offset} seconds")


def in_run(df: DataFrame, ts: str, start: datetime, end: datetime, hours: int = HOURS) -> DataFrame:
    last = run_end(start, end, hours)
    return df.where((F.col(ts) >= F.lit(_utc(start))) & (F.col(ts) < F.lit(_utc(last))))


def window_counts(df: DataFrame, ts: str, start: datetime, end: datetime, late: str | None = None) -> DataFrame:
    """Rows and sum of `value` per window. With `late`, a stream that waits that long for late rows."""
    rows = in_run(df, ts, start, end)
    if late:
        rows = rows.withWatermark(ts, late)
    counted = rows.groupBy(window_of(ts, start).alias("w")).agg(
        F.count("*").alias("n_rows"), F.sum("value").alias("sum_value")
    )
    return counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_rows", "sum_value"
    )
