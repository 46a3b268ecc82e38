"""An index of search hits in time-ordered segments, and a Spark data source that opens only those it needs.

Layout below the index folder:
  segments/load=<name>/   Parquet files; each holds one stretch of time, in order
  bounds/load=<name>/     one row per file: its first and last time and its number of rows
A load replaces itself when it is written again. A scan reads the bounds, leaves out all segments
beyond its time range, and cuts the others into slices, one task each; a slice opens its
file's row groups of the range only. Times given to `read_index` and filters on `at` count alike.
"""

import sys
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual,
)

from adgleaner import schema

# Executors need no copy of this package: the reader travels with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

INDEX_ROW = T.StructType([*schema.INDEX_PAGE.fields, T.StructField("at", T.TimestampType())])
BOUNDS = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
        T.StructField("n_rows", T.LongType()),
    ]
)
_PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def write_index(hits: DataFrame, path: str, load: str, segments: int | None = None, slice_bytes: int = 32 << 20) -> None:
    """Add hits (`_source` payloads) to an index. A hit without a time cannot be asked for and is left out.

    Segments are ranges of time, then URL, so that one moment with very many hits is split as well.
    """
    spark, at = hits.sparkSession, F.try_to_timestamp(F.col("retrieved"))
    rows = hits.select("_source.*").withColumn("at", at).where("at IS NOT NULL").select(*INDEX_ROW.names)
    keys = ("at", "url")
    dealt = rows.repartitionByRange(segments, *keys) if segments else rows.repartitionByRange(*keys)
    folder = f"{path.rstrip('/')}/segments/load={load}"
    # Times as microseconds, so that the bounds of row groups can be read whatever the session writes by default.
    stored = dealt.sortWithinPartitions(*keys).withColumn("at", F.unix_micros("at"))
    stored.write.mode("overwrite").option("parquet.block.size", slice_bytes).parquet(folder)
    bounds = spark.read.schema("at long").parquet(folder).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("n_rows")
    )
    bounds.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/bounds/load={load}")


def read_index(
    spark: SparkSession,
    path: str,
    start: datetime | None = None,
    end: datetime | None = None,
    columns: tuple[str, ...] | None = None,
    slice_rows: int = 200_000,
) -> DataFrame:
    """Rows with `start <= at < end`. `columns` are the only ones read; `at` need not be among them.

    With the session's filter pushdown for Python sources, filters on `at` leave out segments as well.
    """
    spark.dataSource.register(SegmentSource)
    wanted = INDEX_ROW if columns is None else T.StructType([INDEX_ROW[c] for c in columns])
    options = {"path": path, "slice_rows": slice_rows, "pushdown": spark.conf.get(_PUSHDOWN, "false")}
    options |= {name: _micros(t) for name, t in (("start", start), ("end", end)) if t is not None}
    return spark.read.format(SegmentSource.name()).schema(wanted).options(**options).load()


def as_hits(rows: DataFrame) -> DataFrame:
    """Index rows as search hits."""
    return rows.select(F.struct(*schema.INDEX_PAGE.names).alias("_source"))


def _micros(t: datetime) -> int:
    utc = t if t.tzinfo else t.replace(tzinfo=timezone.utc)
    return (utc - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


class Slice(InputPartition):
    """Part `number` of `of` of a segment."""

    def __init__(self, file: str, number: int, of: int):
        super().__init__(None)
        self.file, self.number, self.of = file, number, of


class SegmentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "adgleaner_index"

    def schema(self) -> T.StructType:
        return INDEX_ROW

    def reader(self, schema: T.StructType) -> DataSourceReader:
        kind = FilteredReader if self.options.get("pushdown") == "true" else SegmentReader
        return kind(self.options, schema.names)


class SegmentReader(DataSourceReader):
    def __init__(self, options, columns: list[str]):
        self.path, self.columns = options["path"].rstrip("/"), columns
        self.slice_rows = int(options.get("slice_rows", 200_000))
        # First microsecond wanted, and the first one that is not.
        self.start = int(options["start"]) if "start" in options else None
        self.end = int(options["end"]) if "end" in options else None

    def _beyond(self, first: int, last: int) -> bool:
        return (self.start is not None and last < self.start) or (self.end is not None and first >= self.end)

    def partitions(self) -> list[Slice]:
        system, path = _open(f"{self.path}/bounds")
        wanted = []
        if self.start is not None:
            wanted.append(("last", ">=", self.start))
        if self.end is not None:
            wanted.append(("first", "<", self.end))
        files = pq.read_table(path, filesystem=system, columns=["file", "n_rows"], filters=wanted or None).to_pylist()
        out = []
        for row in sorted(files, key=lambda r: r["file"]):
            of = max(-(-row["n_rows"] // self.slice_rows), 1)
            out += [Slice(row["file"], i, of) for i in range(of)]
        return out

    def read(self, partition: Slice | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark asks for if there are none
            return
        system, path = _open(partition.file)
        with system.open_input_file(path) as source:
            file = pq.ParquetFile(source)
            mine = [g for g in range(file.metadata.num_row_groups) if g % partition.of == partition.number and self._holds(file, g)]
            if not mine:
                return
            needed = [*self.columns, *({"at"} - set(self.columns))]
            for batch in file.iter_batches(row_groups=mine, columns=needed):
                if self.start is not None:
                    batch = batch.filter(pc.greater_equal(batch["at"], self.start))
                if self.end is not None:
                    batch = batch.filter(pc.less(batch["at"], self.end))
                time = pc.cast(batch["at"], pa.timestamp("us", "UTC"))
                yield pa.RecordBatch.from_arrays([time if c == "at" else batch[c] for c in self.columns], self.columns)

    def _holds(self, file: pq.ParquetFile, group: int) -> bool:
        """Whether a row group may have rows of the range, by its own bounds."""
        place = file.schema_arrow.get_field_index("at")
        known = file.metadata.row_group(group).column(place).statistics
        if known is None or not known.has_min_max:
            return True
        return not self._beyond(known.min, known.max)


class FilteredReader(SegmentReader):
    """The same, with filters on `at` that Spark hands over."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            known = getattr(f, "attribute", None) == ("at",) and isinstance(getattr(f, "value", None), datetime)
            if known and isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                at = _micros(f.value) + isinstance(f, GreaterThan)
                self.start = at if self.start is None else max(self.start, at)
            if known and isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                at = _micros(f.value) + (not isinstance(f, LessThan))
                self.end = at if self.end is None else min(self.end, at)
            if not known or not isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo, LessThan, LessThanOrEqual)):
                yield f
