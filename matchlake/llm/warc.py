"""WARC archives with an index of every record, and reads of byte ranges by that index.

Each task writes archives of gzip members, one member per record, and returns one index row per record: archive, offset, length,
url, digest. The index is a table that Spark commits, so an archive of a task that was lost or repeated is simply not
named in it. A reader selects index rows first, sorts them by archive and offset, joins neighbours to larger ranges and
reads each range at once.

Payloads of at least ``revisit_bytes`` that are equal are written once: the row with the largest page_id is the
response, the others are revisits that refer to it.

Edge cases: null html is an empty payload; a null url is left out of the record; a null page_id is smaller than any other and
cannot be referred to; rows with equal page_id and payload as the response are responses too; records of any
length are written and read whole; an empty table gives an empty index; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import sized_strategy
from .packed import release, slices
from .scratch import stored

INDEX = "page_id long, url string, archive string, offset long, length long, digest string"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
EPOCH = "1970-01-01T00:00:00Z"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that all executors share; a bare path is taken as it is."""
    return fs.FileSystem.from_uri(re.sub("^file:/+", "/", uri))


def plan_records(pages: DataFrame, revisit_bytes: int, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """page_id, url, html, digest and refers_to (null for responses) of every row of (page_id, url, html).

    The digests that occur more than once are stored and measured. Up to ``broadcast_bytes`` of them go to the pages, which then stay
    where they are read; more are merged with the pages.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
                        F.sha1(F.encode(html, "UTF-8")).alias("digest"))
    long_ = F.octet_length("html") >= revisit_bytes
    # only digests and ids are shuffled here; a digest that occurs once has no part in the join below
    copied = rows.filter(long_).groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).filter("n > 1 and keeper is not null")
    copied = stored(copied.drop("n"), "warc-copied")
    joined = rows.join(copied.hint(sized_strategy(copied, broadcast_bytes)), "digest", "left")
    return joined.select("page_id", "url", "html", "digest",
                         F.when(long_ & ~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper")).alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record."""
    kind = "response" if refers_to is None else "revisit"
    block = HTTP + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {EPOCH}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}", f"X-Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URL_SAFE = "".join(chr(c) for c in range(0x21, 0x7F))


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def write_archives(pages: DataFrame, folder: str, revisit_bytes: int = 1000, archive_bytes: int = 64 << 20) -> DataFrame:
    """Write archives below ``folder`` and return the index, a table stored in ``folder``/index."""
    spark = pages.sparkSession
    archives = folder.rstrip("/") + "/archives"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(archives)
        system.create_dir(path, recursive=True)
        out, name, offset = None, "", 0
        for batch in batches:
            for part in slices(batch, "html", 8 << 20):
                rows = []
                for page_id, url, html, digest, refers_to in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to"))):
                    if out is None or offset >= archive_bytes:
                        if out is not None:
                            out.close()
                        name, offset = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{path}/{name}", compression=None)
                    member = gzip.compress(record(page_id, url, html.encode(), digest, refers_to), compresslevel=1, mtime=0)
                    out.write(member)
                    rows.append((page_id, url, name, offset, len(member), digest))
                    offset += len(member)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()))],
                        ["page_id", "url", "archive", "offset", "length", "digest"])
        if out is not None:
            out.close()
        release()

    plan_records(pages, revisit_bytes).mapInArrow(write, INDEX).write.parquet(f"{folder}/index")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read_records(selected: DataFrame, folder: str, range_bytes: int = 8 << 20, gap_bytes: int = 64 << 10, task_bytes: int = 128 << 20) -> DataFrame:
    """page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload of the selected index rows.

    Rows of one stretch of an archive go to one task in order of their offset; ranges up to ``gap_bytes`` apart are
    read together. The payload of a response is checked against its digest. The number of tasks follows from the bytes of the
    selected records, of which the index rows that are shuffled show nothing.
    """
    archives = folder.rstrip("/") + "/archives"
    stretch: Column = F.floor(F.col("offset") / F.lit(range_bytes))
    total = selected.agg(F.sum("length")).first()[0] or 0
    cores = selected.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, math.ceil(total / task_bytes), min(cores, math.ceil(total / range_bytes)))
    stretches = selected.select("archive", "offset", "length", stretch.alias("stretch")).repartition(tasks, "archive", "stretch")
    sorted_ = stretches.sortWithinPartitions("archive", "offset")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(archives)
        for batch in batches:
            found: list[tuple] = []
            held = 0
            for archive, members in _joined(batch, range_bytes, gap_bytes):
                start, stop = members[0][0], members[-1][0] + members[-1][1]
                with system.open_input_file(f"{path}/{archive}") as file:
                    file.seek(start)
                    data = file.read(stop - start)
                for offset, length in members:
                    found.append(_result(*parse_record(gzip.decompress(data[offset - start:offset - start + length]))))
                    held += len(found[-1][-1])
                    if held > range_bytes or len(found) >= 1000:
                        yield _batch(found)
                        found, held = [], 0
            if found:
                yield _batch(found)
        release()

    return sorted_.mapInArrow(read, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def _joined(batch: pa.RecordBatch, range_bytes: int, gap_bytes: int) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Archive, and (offset, length) of the records to be read in one go."""
    current, members = None, []
    for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
        if members and (archive != current or offset - sum(members[-1]) > gap_bytes or offset + length - members[0][0] > range_bytes):
            yield current, members
            members = []
        current = archive
        members.append((offset, length))
    if members:
        yield current, members


def _result(fields: dict[str, str], payload: bytes) -> tuple:
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    size = int(fields["X-Payload-Length"])
    if fields["WARC-Type"] == "response":
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"damaged record of page {fields.get('X-Page-ID')}")
        digest = hashlib.sha1(payload).hexdigest()
    number = lambda name: int(fields[name]) if name in fields else None
    return (number("X-Page-ID"), fields.get("WARC-Target-URI"), fields["WARC-Type"], size, digest, number("X-Refers-To-Page-ID"), payload)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
        ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"])
