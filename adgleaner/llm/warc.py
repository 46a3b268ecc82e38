"""WARC archives, written with an index and read back by byte ranges.

Each task writes one archive of records that are compressed one by one, and
returns their index: file, offset, length, address, digest. Reading starts from
the index: the wanted rows are sorted by file and offset, neighbours become one
read, and no byte of other records is parsed.

A payload of at least `least` bytes that several pages share is stored once, with
the largest page id; the others are revisit records that refer to it. Which page
that is comes from a table of ids and digests; markup moves only once, by page id,
so that a payload that a third of all pages share gathers nowhere.

A task that runs again writes a file of another name; the index names only files
of tasks that finished.

Defined results: null markup is an empty payload; a null page id never holds a
payload for others and is always stored in full; rows that repeat an id and its
payload are stored alike; null addresses are left out of the record; control
characters in addresses are percent-encoded; an empty table gives no archives.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from adgleaner.session import shared_folder

INDEX = (
    "page_id bigint, url string, file string, offset bigint, length bigint, "
    "payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
)
RECORD = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def planned(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Pages with payload, digest, and the page id they refer to if they are revisits."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"), F.sha1(payload).alias("digest")
    )
    keys = base.where(F.octet_length("payload") >= least).select("page_id", "digest")
    shared = keys.groupBy("digest").agg(F.max("page_id").alias("last"), F.min("page_id").alias("first"))
    shared = shared.where(F.col("first") < F.col("last")).drop("first")
    revisits = keys.join(shared, "digest").where(F.col("page_id") < F.col("last")).distinct()
    return base.join(revisits, ["page_id", "digest"], "left").withColumnRenamed("last", "refers_to")


def _header_value(text: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    name = f"page:{page_id}" if page_id is not None else f"sha1:{sha1}"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:{name}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def parse(data: bytes) -> dict:
    """Headers and payload of one compressed record. The payload is checked against its digest."""
    import hashlib

    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    sha1 = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != sha1):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload is not what was written")

    def page(name: str) -> int | None:
        m = re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))
        return int(m[1]) if m else None

    return {
        "page_id": page("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": sha1,
        "record_type": kind,
        "refers_to": page("WARC-Refers-To"),
        "payload": payload if kind == "response" else None,
    }


def write_archives(pages: DataFrame, folder: str, least: int = 1000, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the pages below `folder` and return the index, which lies in `folder/index`."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyarrow.fs import FileSystem
        from pyspark import TaskContext

        fs, root = FileSystem.from_uri(folder)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        out, offset = None, 0
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if out is None:
                    fs.create_dir(f"{root}/data", recursive=True)
                    out = fs.open_output_stream(f"{root}/data/{name}", compression=None)
                data = record(r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"], date)
                out.write(data)
                rows.append(
                    {
                        "page_id": r["page_id"],
                        "url": r["url"],
                        "file": f"data/{name}",
                        "offset": offset,
                        "length": len(data),
                        "payload_bytes": len(r["payload"]),
                        "payload_digest": r["digest"],
                        "record_type": "response" if r["refers_to"] is None else "revisit",
                        "refers_to": r["refers_to"],
                    }
                )
                offset += len(data)
            yield pa.RecordBatch.from_pylist(rows, index_schema)
        if out is not None:
            out.close()

    index_schema = _arrow(INDEX)
    planned(pages, least).mapInArrow(write, INDEX).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def read_records(
    index: DataFrame, folder: str, payloads: bool = False, gap: int = 65536, most: int = 8 << 20, task: int = 4 << 20
) -> DataFrame:
    """The records that some index rows name.

    Ranges less than `gap` bytes apart are read at once, up to `most` bytes; a
    longer record is read alone. There is a task for every `task` bytes of records:
    the rows of an index are far smaller than what they name, so their own size says
    nothing about the work.
    """

    def runs(rows: Iterator[dict]) -> Iterator[list[dict]]:
        run: list[dict] = []
        for r in rows:
            if run and (
                r["file"] != run[0]["file"]
                or r["offset"] - (run[-1]["offset"] + run[-1]["length"]) > gap
                or r["offset"] + r["length"] - run[0]["offset"] > most
            ):
                yield run
                run = []
            run.append(r)
        if run:
            yield run

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        fs, root = FileSystem.from_uri(folder)
        name, file = None, None
        for run in runs(r for b in batches for r in b.to_pylist()):
            if run[0]["file"] != name:
                name = run[0]["file"]
                file = fs.open_input_file(f"{root}/{name}")
            first = run[0]["offset"]
            data = file.read_at(run[-1]["offset"] + run[-1]["length"] - first, first)
            cut = (data[r["offset"] - first : r["offset"] - first + r["length"]] for r in run)
            yield pa.RecordBatch.from_pylist([{k: v for k, v in parse(x).items() if k in names} for x in cut], schema)

    kind = RECORD + (", payload binary" if payloads else "")
    schema = _arrow(kind)
    names = set(schema.names)
    wanted = index.select("file", "offset", "length")
    tasks = (wanted.agg(F.sum("length")).first()[0] or 0) // task + 1
    wanted = wanted.repartitionByRange(tasks, "file", "offset")
    return wanted.sortWithinPartitions("file", "offset").mapInArrow(read, kind)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def round_trip(spark: SparkSession, pages: DataFrame, least: int = 1000) -> DataFrame:
    """Write all pages, then read all records back through the index."""
    folder = shared_folder(spark, "warc")
    return read_records(write_archives(pages, folder, least), folder)
