"""WARC archives of web pages, with an index that is written first and read by byte ranges.

``write_archives`` writes one gzip member per record, straight from the tasks that
scan the pages, and returns the index: archive, offset, length, URL, digest and
type of each record.  The index is the truth: an archive is named by the task's
attempt, so what a lost or repeated attempt has written is never pointed at.

``read_records`` takes any selection of the index, sorts it by archive and
offset, joins neighbouring ranges into reads of at most ``READ_BYTES`` (a gap of
up to ``GAP_BYTES`` is read over) and parses the records.  ``resolve`` gives
revisits the payload size and digest of the record that they refer to, as read.

Of records with equal payloads of at least ``REVISIT_BYTES`` the one with the
largest page_id holds the payload, the others are revisits.  Only digests that
occur more than once meet the pages again; they are counted and broadcast when
few, so that pages are moved only for more than ``BROADCAST_IDS`` such digests.

Folders are those that ``pyarrow.fs`` opens by URI (file, s3, gs, hdfs) and must be
seen by all executors, as ``spark.checkpoint.dir`` must.

Defined cases: null html is an empty payload; a null url is empty; a null page_id
is never the largest, and a group of nulls only holds responses; rows that repeat
the largest page_id with the same payload are responses too; characters of a URL
that would end a header line are percent-encoded in the record and kept in the
index; an empty table gives no archive and no rows; other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklens.llm.common import BROADCAST_IDS, materialize
from worklens.session import scratch_path

#: Payloads shorter than this are always stored.
REVISIT_BYTES = 1000
#: Size at which a task begins its next archive.
ARCHIVE_BYTES = 256 << 20
#: Largest read, and largest gap between two records of one read.
READ_BYTES, GAP_BYTES = 8 << 20, 64 << 10
#: Bytes of records that one reading task is given, about.
TASK_BYTES = 32 << 20
#: Date of the records: pages carry none, and equal input gives equal archives.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SPACE = uuid.UUID("7f0c1f2e-5a54-4c57-9d0e-7d9f6f3c2b11")

INDEX = ("page_id long, url string, archive string, offset long, length long, digest string, "
         "payload_bytes long, record_type string, refers_to long")
RECORDS = ("page_id long, url string, record_type string, refers_to long, digest string, "
           "payload_bytes long, payload binary")


def filesystem(uri: str):
    """(file system, path) of a folder's URI or plain path."""
    from pyarrow import fs
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.FileSystem.from_uri("file://" + uri.removeprefix("file:"))


# records -----------------------------------------------------------------------------------

def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(RECORD_SPACE, f'{page_id} {digest}')}>"


def header_uri(url: str | None) -> str:
    return "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode())
                   for c in url or "")


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str,
                refers_to: int | None, revisit: bool) -> bytes:
    """One gzip member: WARC headers, HTTP headers, payload (none in a revisit)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {header_uri(url)}",
             f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}",
                  f"X-Refers-To-Page-Id: {refers_to}"]
    plain = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(plain) + z.flush()


def parse_record(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload; names in lower case."""
    plain = zlib.decompress(member, 31)
    head, rest = plain.split(b"\r\n\r\n", 1)
    version, warc = _fields(head)
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record: {version[:40]!r}")
    size = int(warc["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    http_head, payload = rest[:size].split(b"\r\n\r\n", 1)
    return warc, _fields(http_head)[1], payload


def _fields(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    pairs = (x.partition(":") for x in lines)
    return first, {k.strip().lower(): v.strip() for k, _, v in pairs}


# writing -----------------------------------------------------------------------------------

def with_types(pages: DataFrame) -> DataFrame:
    """page_id, url, html (binary), digest, payload_bytes, record_type, refers_to."""
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha1("html")).withColumn(
        "payload_bytes", F.octet_length("html").cast("long"))
    twice = materialize(
        rows.where(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy(F.col("digest").alias("k_digest"), F.col("payload_bytes").alias("k_bytes"))
        .agg(F.max("page_id").alias("largest"), F.count("*").alias("copies")).where("copies > 1"),
        "warc-repeated")
    small = twice.count() <= BROADCAST_IDS
    same = (F.col("digest") == F.col("k_digest")) & (F.col("payload_bytes") == F.col("k_bytes"))
    rows = rows.join(F.broadcast(twice) if small else twice, same, "left")
    revisit = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return rows.select("page_id", "url", "html", "digest", "payload_bytes",
                       F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                       F.when(revisit, F.col("largest")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every page's record below ``folder``; the index, as a table there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        ctx = TaskContext.get()
        name = f"part-{ctx.partitionId():06d}-{ctx.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        out, n, at = None, 0, 0
        try:
            for b in batches:
                rows = []
                for page_id, url, html, digest, size, kind, refers in zip(
                        *(c.to_pylist() for c in b.columns), strict=True):
                    if out is None or at >= archive_bytes:
                        if out is not None:
                            out.close()
                        archive, n, at = f"{name}-{n:05d}.warc.gz", n + 1, 0
                        out = fs.open_output_stream(f"{root}/{archive}", compression=None)
                    member = make_record(page_id, url, html, digest, refers, kind == "revisit")
                    out.write(member)
                    rows.append((page_id, url, archive, at, len(member), digest, size, kind, refers))
                    at += len(member)
                yield _batch(rows, INDEX)
        finally:
            if out is not None:
                out.close()

    index = with_types(pages).mapInArrow(run, INDEX)
    path = f"{folder.rstrip('/')}/index"
    index.write.parquet(path)  # commits the index rows of one attempt of each task
    return index.sparkSession.read.schema(INDEX).parquet(path)


_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    cols = zip(*rows, strict=True) if rows else ([] for _ in fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[t]) for c, (_, t) in zip(cols, fields, strict=True)],
                                      names=[n for n, _ in fields])


# reading -----------------------------------------------------------------------------------

def coalesce_ranges(ranges: Iterable[tuple[str, int, int]], read_bytes: int = READ_BYTES,
                    gap_bytes: int = GAP_BYTES) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """(archive, start, end, its ranges) of each read, for ranges sorted by archive and offset."""
    now = None
    for archive, offset, length in ranges:
        end = offset + length
        if now and now[0] == archive and offset - now[2] <= gap_bytes and end - now[1] <= read_bytes:
            now[2] = max(now[2], end)
            now[3].append((offset, length))
        else:
            if now:
                yield tuple(now)
            now = [archive, offset, end, [(offset, length)]]
    if now:
        yield tuple(now)


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of the index rows given (RECORDS), read by coalesced byte ranges.

    ``digest`` is what the record says; ``payload`` is what was stored (empty for
    a revisit), ``payload_bytes`` its full size by the HTTP headers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        ranges = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        opened, source = None, None
        for archive, start, end, parts in coalesce_ranges(ranges):
            if archive != opened:
                opened, source = archive, fs.open_input_file(f"{root}/{archive}")
            data, rows = memoryview(source.read_at(end - start, start)), []
            for offset, length in parts:
                warc, http, payload = parse_record(data[offset - start:offset - start + length])
                page, refers = warc.get("x-page-id"), warc.get("x-refers-to-page-id")
                rows.append((None if page is None else int(page), warc["warc-target-uri"],
                             warc["warc-type"], None if refers is None else int(refers),
                             warc["warc-payload-digest"].removeprefix("sha1:"),
                             int(http["content-length"]), payload))
            yield _batch(rows, RECORDS)

    order, rows = ["archive", "offset"], index.select("archive", "offset", "length")
    # Tasks by the bytes to be read: the index rows themselves are too small to tell.
    tasks = 1 + (rows.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES
    return (rows.repartitionByRange(tasks, *order)
            .sortWithinPartitions(*order).mapInArrow(run, RECORDS))


def resolve(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each record read.

    A response's size and digest are those of its payload as read, a revisit's
    those of the response it refers to, if that was read too (else null).
    """
    rows = materialize(records.select(
        "page_id", "record_type", "refers_to",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), F.col("digest").alias("said")), "warc-read")
    held = (rows.where("record_type = 'response'")
            .groupBy(F.col("page_id").alias("of"), F.col("payload_digest").alias("of_digest"))
            .agg(F.max("payload_bytes").alias("of_bytes")))
    back = rows.where("record_type = 'revisit'").join(
        held, (F.col("refers_to") == F.col("of")) & (F.col("said") == F.col("of_digest")), "left")
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return rows.where("record_type = 'response'").select(*cols).unionByName(back.select(
        "page_id", F.col("of_bytes").alias("payload_bytes"), F.col("of_digest").alias("payload_digest"),
        "record_type", "refers_to"))


def write_and_read(pages: DataFrame) -> DataFrame:
    """Archive all pages in the shared scratch folder and read all of them back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return resolve(read_records(write_archives(pages, folder), folder))
