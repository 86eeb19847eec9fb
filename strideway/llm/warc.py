"""WARC archives: a writer with revisit records, and a reader that salvages what damaged archives still hold.

Each record is a gzip member of its own, so a reader can start at any of them. The salvage reader walks an
archive member by member. Where a check fails (no gzip header, a broken stream, a bad version line, a
content length that doesn't fit, a payload whose digest differs) it searches for the next valid gzip
member, or in plain archives for the next version line, recovers the records from there on, and logs the
bytes it had to skip as a quarantined gap.

Archives of a bounded size are written by the executors to the shared folder under a temporary name and
renamed when whole; name and content depend on the partition's rows alone, so a task that runs again
leaves the same files. They are read with Spark's own binary reader.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideway.llm import text_kernel as K
from strideway.plans.lineage import cut, new_path

#: Payloads of fewer bytes are always written in full.
REVISIT_BYTES = 1000
#: An archive is closed once it holds this many bytes.
ARCHIVE_BYTES = 16 << 20
_DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_END = b"\r\n\r\n"
#: How a gzip member and a record begin.
_MEMBER, _VERSION = b"\x1f\x8b\x08", b"WARC/1."
_MAX_HEADER = 1 << 16
#: Compressed bytes that are inflated at once.
_SLICE = 1 << 15
#: Payload digests that are checked; records with any other are taken as they are.
_DIGESTS = {"md5", "sha1", "sha256", "sha512"}


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes


class Gap(NamedTuple):
    start: int
    end: int
    reason: str


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record, as a gzip member of its own."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + _END) + packer.flush()


def _header_value(text: str) -> str:
    """A header's value on one line, with anything but printable ASCII percent-encoded."""
    return "".join(c if " " < c <= "~" and c != "%" else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    """A record's id: what tells its page apart decides it, so a revisit can name its response wherever that is."""
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'record {page_id} {url} {digest}')}>"


def page_record(page_id: int | None, url: str | None, html: str | None, digest: str, refers_to: int | None, revisit: bool, refers_url: str | None = None) -> bytes:
    """The record of a page; ``digest`` is its payload's SHA-1 in hex, ``refers_to`` and ``refers_url`` are of the response that it revisits."""
    payload = (html or "").encode()
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, url, digest)),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", _header_value(url or "")),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if revisit:
        headers += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id(refers_to, refers_url, digest)), ("WARC-Refers-To-Target-URI", _header_value(refers_url or "")), ("X-Refers-To-Page", str(refers_to)), ("WARC-Truncated", "length")]
        payload = b""
    return record_bytes([*headers, ("Content-Type", "application/http; msgtype=response")], http + payload)


def _parse(data: bytes, at: int, header: int = _MAX_HEADER) -> tuple[Record, int] | str:
    """The record at ``at`` and where it ends, or what is wrong with it; its headers end within ``header`` bytes."""
    if not data.startswith(_VERSION, at):
        return "no version line"
    stop = data.find(b"\r\n\r\n", at, at + header)
    if stop < 0:
        return "no end of the headers"
    headers = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        k, colon, v = line.partition(b":")
        if not colon:
            return "a header line without a colon"
        headers[k.decode("utf-8", "replace").strip().lower()] = v.decode("utf-8", "replace").strip()
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        return "no content length"
    begin, end = stop + 4, stop + 4 + int(length)
    if data[end : end + 4] != _END:
        return "the content length doesn't fit"
    record = Record(headers, data[begin:end])
    algorithm, value = _digest_of(headers)
    if value and headers.get("warc-type") == "response" and hashlib.new(algorithm, payload_of(record)).digest() != value:
        return "the payload's digest differs"
    return record, end + 4


def _digest_of(headers: dict[str, str]) -> tuple[str, bytes]:
    """(algorithm, digest) that a record states of its payload, in hex or base 32; ("", b"") if that can't be read."""
    algorithm, _, value = headers.get("warc-payload-digest", "").partition(":")
    algorithm = algorithm.strip().lower().replace("-", "")
    if algorithm not in _DIGESTS:
        return "", b""
    size, value = hashlib.new(algorithm).digest_size, value.strip()
    try:
        found = bytes.fromhex(value) if len(value) == 2 * size else base64.b32decode(value.upper() + "=" * (-len(value) % 8))
    except ValueError:
        return "", b""
    return (algorithm, found) if len(found) == size else ("", b"")


def payload_of(record: Record) -> bytes:
    """The block without its HTTP headers, if it has any."""
    if not record.headers.get("content-type", "").startswith("application/http"):
        return record.block
    return record.block.partition(b"\r\n\r\n")[2]


def _inflate(data: bytes, at: int) -> tuple[bytes, int] | None:
    """The gzip member at ``at`` and where it ends; None if it is broken."""
    d, out, view = zlib.decompressobj(31), [], memoryview(data)
    # In slices: what a member leaves over is copied, and must not be the rest of the archive.
    while not d.eof and at < len(data):
        try:
            out.append(d.decompress(view[at : at + _SLICE]))
        except zlib.error:
            return None
        at = min(len(data), at + _SLICE)
    return (b"".join(out), at - len(d.unused_data)) if d.eof else None


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """Records of an archive (gzip members, plain text, or both), and gaps for the bytes that give none."""
    at, lost, reason = 0, -1, ""
    begins = re.compile(re.escape(_MEMBER) + b"|" + re.escape(_VERSION))
    while at < len(data):
        if data.startswith(_MEMBER, at):
            member = _inflate(data, at)
            found: tuple[list[Record], int] | str = "a broken gzip member"
            if member:
                records, inner = [], 0
                found = "an empty gzip member"
                while inner < len(member[0]):
                    one = _parse(member[0], inner, len(member[0]))
                    if isinstance(one, str):
                        found = one
                        break
                    records.append(one[0])
                    inner = one[1]
                else:
                    if records:
                        found = (records, member[1])
                if isinstance(found, str) and records:  # what came whole before the damage counts
                    found = (records, member[1])
                    yield Gap(at, member[1], "a damaged record inside a member")
        else:
            one = _parse(data, at)
            found = one if isinstance(one, str) else ([one[0]], one[1])
        if isinstance(found, str):
            if lost < 0:
                lost, reason = at, found
            ahead = begins.search(data, at + 1)
            at = ahead.start() if ahead else len(data)
            continue
        if lost >= 0:
            yield Gap(lost, at, reason)
            lost = -1
        yield from found[0]
        at = found[1]
    if lost >= 0:
        yield Gap(lost, len(data), reason)


def _store(folder: str, name: str, data: bytes) -> None:
    """Put a whole file into the shared folder, whatever holds it."""
    scheme, mark, rest = folder.partition(":")
    if not mark or scheme == "file":
        local = "/" + (rest if mark else folder).lstrip("/")
        os.makedirs(local, exist_ok=True)
        hidden = os.path.join(local, f".{name}.{uuid.uuid4().hex}")
        with open(hidden, "wb") as f:
            f.write(data)
        os.replace(hidden, os.path.join(local, name))
        return
    from pyarrow import fs

    system, base = fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", folder))
    system.create_dir(base, recursive=True)
    hidden = f"{base}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(hidden) as f:
        f.write(data)
    system.move(hidden, f"{base}/{name}")


def _write(folder: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            nonlocal number, held, size
            name = f"part-{part:06d}-{number:05d}.warc.gz"
            _store(folder, name, b"".join(held))
            out = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(held)], pa.int64())], names=["archive", "records"])
            number, held, size = number + 1, [], 0
            return out

        for batch in batches:
            for row in batch.to_pylist():
                one = page_record(row["page_id"], row["url"], row["html"], row["digest"], row["refers_to"], row["revisit"], row["refers_url"])
                held.append(one)
                size += len(one)
                if size >= limit:
                    yield close()
        if held:
            yield close()

    return run


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record per page into archives in ``folder``; a table of (archive, records).

    Of pages with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the largest page_id is a
    response and the others revisit it; all others are responses. Null html: an empty payload. Rows that
    repeat the largest page_id are all responses; rows without page_id revisit, unless no page of their
    payload has one. Other columns are ignored.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    is_large = F.octet_length("html") >= REVISIT_BYTES
    large = slim.where(is_large)
    # Counted first, on digests alone; only those that repeat are sorted for their largest page.
    repeated = cut(large.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"), "warc-repeated")
    first = large.select("digest", "page_id", "url").join(repeated, "digest").groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("main"))
    # Both sides are tables, so that adaptive execution can split a payload that very many pages have; small payloads don't move.
    marked = large.join(cut(first.select("digest", "main.page_id", "main.url").toDF("digest", "main", "main_url"), "warc-main"), "digest", "left")
    revisit = F.coalesce(F.col("main").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("main")), F.lit(False))
    own = ["page_id", "url", "html", "digest"]
    rows = marked.select(*own, F.when(revisit, F.col("main")).alias("refers_to"), F.when(revisit, F.col("main_url")).alias("refers_url"), revisit.alias("revisit"))
    rest = slim.where(~is_large).select(*own, F.lit(None).cast("long").alias("refers_to"), F.lit(None).cast("string").alias("refers_url"), F.lit(False).alias("revisit"))
    # Sorted, so that a task that runs again cuts the same archives.
    return cut(rows.union(rest).sortWithinPartitions("page_id", "url", "digest").mapInArrow(K.tidy(_write(folder, archive_bytes)), "archive string, records long"), "warc-archives")


_RECORD = "archive string, kind string, page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long, gap_start long, gap_end long, reason string"


def _number(text: str | None) -> int | None:
    """A header's 64-bit integer; None if it holds anything else."""
    if text is None or not re.fullmatch(r"-?[0-9]{1,19}", text):
        return None
    return int(text) if -(2**63) <= int(text) < 2**63 else None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from urllib.parse import unquote

    names = [x.split(" ")[0] for x in _RECORD.split(", ")]
    types = [pa.binary() if " binary" in x else pa.int64() if " long" in x else pa.string() for x in _RECORD.split(", ")]
    schema = pa.schema(list(zip(names, types, strict=True)))
    for batch in batches:
        for k in range(batch.num_rows):
            path, data, rows = batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), []
            for x in salvage(data):
                if isinstance(x, Gap):
                    rows.append({"archive": path, "kind": "gap", "gap_start": x.start, "gap_end": x.end, "reason": x.reason})
                    continue
                h, payload = x.headers, payload_of(x)
                again = h.get("warc-type") == "revisit"  # the payload is elsewhere: only its headers tell of it
                algorithm, value = _digest_of(h)
                digest = (value.hex() if algorithm == "sha1" else None) if again else hashlib.sha1(payload).hexdigest()
                size = _number(h.get("x-payload-length")) if again else len(payload)
                rows.append(
                    {
                        "archive": path, "kind": "record", "page_id": _number(h.get("x-page-id")), "url": unquote(h.get("warc-target-uri", "")), "payload": None if again else payload,
                        "payload_bytes": size, "payload_digest": digest, "record_type": h.get("warc-type"), "refers_to": _number(h.get("x-refers-to-page")),
                    }
                )
                if len(rows) >= 2000:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """All records that the archives in ``folder`` still give (kind ``record``), and the gaps between them (kind ``gap``).

    A gap row has the byte range that was skipped in the archive, and why; null, empty and foreign files
    give gaps or nothing, never an error. Digests may be in hex or base 32, and by any algorithm: those that this
    module knows are checked. Numbers in headers that are none become null, and so does what a revisit doesn't tell.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder).select("path", "content")
    return files.mapInArrow(K.tidy(_read), _RECORD)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    See ``write_archives`` for nulls, ties and repeated rows; no pages give no rows.
    """
    spark = pages.sparkSession
    folder = new_path(spark, "warc")
    if not write_archives(pages, folder).limit(1).count():
        return spark.createDataFrame([], _RECORD).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return read_archives(spark, folder).where("kind = 'record'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The same in DuckDB.
ROUND_TRIP_SQL = """
select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest,
       case when main is null or page_id = main then 'response' else 'revisit' end as record_type,
       case when page_id <> main then main end as refers_to
from (
    select page_id, html, case when octet_length(encode(coalesce(html, ''))) >= 1000 then max(page_id) over (partition by coalesce(html, '')) end as main from pages
)
"""
